import importlib
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark, small):
    assert entry.entry(spark).count() == 3


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_know_the_subpackage():
    for p in (ROOT / "lodestone").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT / "lodestone").parts:
            assert "llm" not in p.read_text(), p


def core():
    return importlib.import_module("lodestone.plans.catalog")


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: repr(round(float(v), 6)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(core().oracle_sql()))
def test_query_equals_its_sql(spark, small, name):
    con = duckdb.connect()
    for p in Path(small).iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = core().queries()[name](spark, small)
    cur = con.execute(core().oracle_sql()[name])
    assert _rows(df.columns, df.collect()) == _rows([c[0] for c in cur.description], cur.fetchall())


def test_version():
    out = subprocess.run([sys.executable, "-m", "lodestone.cli", "version"], cwd=ROOT, capture_output=True, text=True, check=True)
    assert out.stdout.startswith("lodestone")

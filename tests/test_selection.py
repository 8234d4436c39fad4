
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.config import SelectionConfig
from lodestone.operators import runs, selection
from lodestone.report import model_card, samples_markdown, selection_markdown

SCHEMA = "run_id string, run_name string, method string, quality double, latency_ms double, memory_mb double, model_size_mb double, cost_per_1k_usd double, is_baseline boolean, _idx bigint, dataset_version string"


def table(spark, *rows):
    full = []
    for i, r in enumerate(rows):
        d = {"quality": 0.5, "latency_ms": 200.0, "memory_mb": 2000.0, "model_size_mb": 1000.0, "cost_per_1k_usd": 0.04, "is_baseline": False, "method": "lora"} | r
        full.append((d.get("run_id", f"r{i}"), d.get("run_name", f"n{i}"), d["method"], d["quality"], d["latency_ms"], d["memory_mb"], d["model_size_mb"], d["cost_per_1k_usd"], d["is_baseline"], i, "v1"))
    return selection.candidates(spark.createDataFrame(full, SCHEMA))


def test_gates(spark):
    c = table(spark, {"quality": 0.70, "is_baseline": True}, {"quality": 0.50}, {"quality": 0.70}, {"quality": 0.9, "latency_ms": 500.0, "memory_mb": 9000.0})
    cfg = SelectionConfig(max_latency_ms=300.0, max_memory_mb=5000.0)
    got = [r.rejected_reasons for r in selection.gated(c, cfg).orderBy("_idx").collect()]
    assert got == [["is_baseline"], ["quality_ratio"], ["not_above_baseline"], ["latency", "memory"]]
    loose = SelectionConfig(require_beats_baseline=False)
    assert selection.gated(c, loose).where("_idx = 2").first().rejected_reasons == []
    zero = table(spark, {"quality": 0.0, "is_baseline": True}, {"quality": 0.0})
    assert selection.gated(zero).where("_idx = 1").first().rejected_reasons == []


def test_balanced_beats_slow_best(spark):
    c = table(spark, {"quality": 0.5, "is_baseline": True}, {"quality": 0.80, "latency_ms": 900.0, "memory_mb": 9000.0}, {"quality": 0.78, "latency_ms": 150.0, "memory_mb": 1500.0})
    r = selection.ranked(c).orderBy("rank").collect()
    assert [x.run_id for x in r] == ["r2", "r1"]
    g = selection.gains(c).first()
    assert g.champion == "r2" and abs(g.quality_gain - 0.28) < 1e-9 and abs(g.speedup - 200 / 150) < 1e-9


def test_flat_axis_ties_and_missing(spark):
    c = table(spark, {"quality": 0.6}, {"quality": 0.6}, {"quality": None}, {"quality": float("nan")}, {"quality": 0.6, "cost_per_1k_usd": float("inf")})
    n = selection.normalized(c).orderBy("_idx").collect()
    assert [r.run_id for r in n] == ["r0", "r1", "r4"] and all(r.n_quality == 1.0 for r in n)
    assert n[2].cost_per_1k_usd == 0.0 and n[2].n_cost == 1.0
    assert [r.run_id for r in selection.ranked(c).orderBy("rank").collect()] == ["r4", "r0", "r1"]
    assert selection.gains(c).first().baseline is None


def test_empty(spark):
    c = table(spark, {"quality": None})
    assert selection.ranked(c).count() == selection.pareto(c).count() == selection.status(c).count() == 0


@given(st.lists(st.tuples(*[st.integers(0, 3) for _ in range(5)]), min_size=1, max_size=12))
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_pareto_against_brute_force(spark, points):
    c = table(spark, *[dict(zip(("quality", "latency_ms", "memory_mb", "model_size_mb", "cost_per_1k_usd"), map(float, p))) for p in points])
    sign = lambda p: (p[0], -p[1], -p[2], -p[3], -p[4])
    dom = lambda a, b: all(x >= y for x, y in zip(sign(a), sign(b))) and a != b
    want = {i for i, p in enumerate(points) if not any(dom(q, p) for q in points)}
    assert {r._idx for r in selection.pareto(c).collect()} == want


def test_reports(spark):
    c = table(spark, {"quality": 0.7, "is_baseline": True, "run_name": "base"}, {"quality": 0.5}, {"quality": 0.9})
    text = selection_markdown(c)
    assert "**champion**" in text and "71.4% of baseline (< 90%)" in text and "n2 *" in text
    assert "## Measured" in model_card({"run_name": "x", "run_id": "r"}, {"q": 0.5}, {"rows": 3}, c)
    s = spark.createDataFrame([("worst", 0.1, "i", "r", "p")], "bucket string, s double, instruction string, reference string, prediction string")
    assert "[worst] score = 0.1" in samples_markdown(s, "s")


def test_store(spark, tmp_path):
    s = runs.Store(spark, f"file://{tmp_path}/store")
    assert s.resolve("m", "champion") is None
    s.start_run("r1", "one", {"arm": "baseline"})
    s.start_run("r2", "two")
    rows = [("r1", "q", 0.5, 0, None), ("r1", "q", 0.6, 1, None), ("r2", "q", float("nan"), 0, None), ("r2", "l", 3.0, 0, None), ("r2", "q", 0.7, 0, None)]
    s.append("metrics", spark.createDataFrame(rows, runs.METRICS))
    got = {r.run_id: r for r in runs.candidates_from_runs(s.table("runs"), s.table("metrics"), {"quality": "q", "latency_ms": "l"}, "quality").collect()}
    assert got["r1"].quality == 0.6 and got["r1"].is_baseline and got["r1"].latency_ms == 0.0 and got["r2"].latency_ms == 3.0
    assert s.promote("m", None) is None and s.promote("m", "r2", dry_run=True) is None
    assert s.promote("m", "r2", "r1") == 1 and s.resolve("m", "champion") == 1 and s.resolve("m", "challenger") == 2
    s.rollback("m", 2)
    assert s.resolve("m", "champion") == 2
    with pytest.raises(ValueError):
        s.rollback("m", 9)
    assert runs.merged_tags({"a": "1"}, {"a": "2"}, {"a": "3"}) == {"a": "3"}
    assert runs.git_commit(str(tmp_path)) == "unknown"


def test_relative_table_keeps_null_for_a_zero_baseline(spark):
    c = table(spark, {"quality": 0.0, "is_baseline": True}, {"quality": 0.5, "latency_ms": 100.0})
    r = selection.relative_to_baseline(c).first()
    assert r.quality_vs_baseline is None and r.latency_ms_vs_baseline == 0.5
    assert selection.experiment_results(c).where(F.col("on_pareto_frontier")).first().run_id == "r1"

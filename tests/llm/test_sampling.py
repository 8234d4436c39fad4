import numpy as np
from pyspark.sql import functions as F

from lodestone.llm import sampling

TARGETS = "category string, target_share double, min_rows bigint, sample_fraction double"


def test_rake_keeps_categories_and_capacity():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 60, (5, 8)).astype(float)
    counts[4] = [0, 0, 0, 0, 0, 0, 0, 3]
    goals = np.minimum(np.array([40.0, 20, 10, 5, 9]), counts.sum(1))
    d = sampling.rake(counts, goals)
    assert np.allclose(d.sum(1), goals) and (d <= counts + 1e-9).all() and (d >= 0).all()


def test_sample(spark, raw):
    rows = [{"category": c, "response": "x" * (i % 500), "context": "c" if i % 3 else None} for i, c in enumerate(["open_qa"] * 300 + ["Open Qa/Zorn"] * 100 + ["coding"] * 30 + ["rare - X"] * 4 + [None, "", "other"] * 22)]
    df = raw(*rows, idx=F.lit("clash"), key=F.lit(1), bin=F.lit(2), cell=F.lit(3))
    t = spark.createDataFrame([("open_qa", 0.6, 5, 0.2), ("coding", 0.1, 20, 0.2), ("rare", 0.2, 5, 0.2), ("debate", 0.1, 2, 0.2), (None, 0.5, 1, 0.2)], TARGETS)
    drawn, report = sampling.sample(df, t)
    r = {x.category: x for x in report.collect()}
    assert (r["open_qa"].drawn, r["coding"].drawn, r["rare"].drawn, r["debate"].drawn) == (60, 20, 4, 0)
    assert {c for c, x in r.items() if x.unmet} == {"rare", "debate"} and {c for c, x in r.items() if x.below_minimum} == {"rare", "debate"}
    a = sorted(x.idx for x in drawn.collect())
    assert len(set(a)) == len(a) == 84 and a == sorted(x.idx for x in sampling.sample(df.repartition(5), t)[0].collect())
    base = {x._idx: x.category for x in df.select("_idx", "category").collect()}
    assert all((base[x.idx] or "").lower().replace(" ", "_").startswith(x.category) for x in drawn.collect())


def test_defined_cases(spark, raw):
    t = spark.createDataFrame([("a", 0.5, None, 1.0), ("b", None, 1, 1.0)], TARGETS)
    drawn, report = sampling.sample(raw(), t)
    assert drawn.count() == 0 and not any(r.unmet for r in report.collect())
    same = raw(*[{"_idx": 1, "category": "a"}] * 10, *[{"_idx": 2, "category": "B"}] * 3)
    assert {r.category: r.drawn for r in sampling.sample(same, t)[1].collect()} == {"a": 6, "b": 1}
    assert sampling.sample(same, t.limit(0))[0].count() == 0


def test_the_unmet_targets_come_with_a_draw(spark, raw):
    from glob import glob

    from lodestone.session import shared_dir

    written = lambda: set(glob(f"{shared_dir(spark).removeprefix('file://').removeprefix('file:')}/*/p4-drawn-*/*.parquet"))
    before = written()
    t = spark.createDataFrame([("a", 0.5, 1, 1.0), ("b", 0.5, 1, 1.0)], TARGETS)
    report = sampling.sample(raw(*[{"category": "a"}] * 8, {"category": "b"}), t)[1]
    assert [r.category for r in report.where("unmet").select("category").collect()] == ["b"]
    assert written() - before

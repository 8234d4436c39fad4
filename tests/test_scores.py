import math
import statistics

import pytest
from pyspark.sql import functions as F

from lodestone.functions import numeric as N
from lodestone.functions import text as T
from lodestone.operators import prompts as P
from lodestone.operators import quality as Q
from lodestone.operators import stats as S


def test_scores(spark):
    rows = [(0, "cat sat mat", "cat sat mat quietly"), (1, "cat cat", "cat"), (2, "", ""), (3, "x", ""), (4, "a b c d", "b"), (5, None, "x")]
    s = {r._idx: r for r in Q.scored(spark.createDataFrame(rows, "_idx int, prediction string, reference string")).collect()}
    assert math.isclose(s[0].token_f1, 6 / 7) and math.isclose(s[1].token_f1, 2 / 3)
    assert s[2].token_f1 == s[2].rouge_l == s[2].exact_match == 1.0 and s[2].length_ratio == 0.0
    assert s[3].token_f1 == 0.0 and s[4].length_ratio == 3.0 and s[5].rouge_l == 0.0
    p, r = 1.0, 3 / 4
    assert math.isclose(s[0].rouge_l, 2.44 * p * r / (r + 1.44 * p))


def test_macro_means(spark):
    e = Q.scored(spark.createDataFrame([], "_idx int, prediction string, reference string"))
    m = Q.macro_means(e, ("token_f1",)).first()
    assert m.token_f1 == 0.0 and m.n == 0
    with pytest.raises(ValueError):
        Q.macro_means(e, ("bleu",))


def test_strict_pairs(spark):
    a = spark.createDataFrame([(0, "p")], "_idx int, prediction string")
    b = spark.createDataFrame([(0, "r"), (1, "r")], "_idx int, reference string")
    assert Q.paired(a, b.where("_idx = 0"), ["_idx"]).count() == 1
    with pytest.raises(ValueError):
        Q.paired(a, b, ["_idx"])


def test_best_and_worst_overlap_when_few(spark):
    df = spark.createDataFrame([("r", i, i / 10) for i in range(12)], "run_id string, _idx bigint, s double")
    got = Q.best_and_worst(df, "run_id", "s").collect()
    assert sorted(r._idx for r in got if r.bucket == "worst") == list(range(10))
    assert sorted(r._idx for r in got if r.bucket == "best") == [7, 8, 9, 10, 11]


@pytest.mark.parametrize("values", [list(range(1, 101)), [3, 1, 2], [5], [1, 1, 1, 9]])
def test_rank_pick(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    v = sorted(values)
    for q in (0.0, 0.5, 0.95, 1.0):
        assert S.rank_pick(df, [], "v", {"p": q}, "floor").first().p == v[int(q * (len(v) - 1))]
        assert S.rank_pick(df, [], "v", {"p": q}, "round").first().p == v[round(q * (len(v) - 1))]


def test_rank_pick_of_nothing(spark):
    assert S.rank_pick(spark.createDataFrame([(None,)], "v double"), [], "v", {"p": 0.5}, "floor").first().p == 0.0


def test_latency_summary(spark):
    v = [10.0, 20.0, 30.0, 45.0]
    r = S.latency_summary(spark.createDataFrame([("a", x, 64) for x in v] + [("b", 7.0, 64), ("a", None, 1)], "m string, ms double, t int"), ["m"], "ms", "t").orderBy("m").collect()
    assert r[0].n == 4 and r[0].median_ms == 25.0 and math.isclose(r[0].std_ms, statistics.stdev(v)) and r[0].p95_ms == 45.0
    assert r[1].std_ms == 0.0 and math.isclose(r[1].tokens_per_second, 64 / 0.007)


def test_costs(spark):
    rows = [(100.0, 1), (0.0, 1), (-5.0, 1)]
    got = spark.createDataFrame(rows, "ms double, b int").select(N.requests_per_hour(F.col("ms"), F.col("b")).alias("r"), N.cost_per_1k(F.lit(1.0), N.requests_per_hour(F.col("ms"), F.col("b"))).alias("c")).collect()
    assert got[0].r == 36000.0 and math.isclose(got[0].c, 1 / 36) and got[1].r == 0.0 and got[1].c == got[2].c == math.inf


def test_steps(spark):
    rows = [(100, 16, 2.0, -1), (64, 16, 1.0, -1), (1, 16, 1.0, 0), (100, 16, 2.0, 30)]
    df = spark.createDataFrame(rows, "n int, b int, e double, m int")
    assert [r[0] for r in df.select(N.optimizer_steps(*[F.col(c) for c in "nbem"])).collect()] == [14, 4, 1, 30]


def test_perplexity(spark):
    df = spark.createDataFrame([("a", 2.0, 10), ("a", 1.0, 30), ("b", 50.0, 5), ("c", 1.0, 0)], "k string, l double, t int")
    got = {r.k: r.perplexity for r in S.perplexity(df, ["k"], "l", "t").collect()}
    assert math.isclose(got["a"], math.exp(50 / 40)) and math.isclose(got["b"], math.exp(20)) and got["c"] == math.inf


def test_throughput_stops_at_the_first_failure(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, False), ("a", 4, True), ("a", 8, False), ("b", 1, False)], "k string, s int, oom boolean")
    assert sorted((r.k, r.s) for r in S.throughput_curve(df, ["k"], "s", "oom").collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_newest_and_peak(spark):
    df = spark.createDataFrame([(i, "a", float(i % 7)) for i in range(50)], "i bigint, k string, v double")
    assert sorted(r.i for r in S.newest(df, ["k"], [F.desc("i")], 10).collect()) == list(range(40, 50))
    peaks = [r.peak for r in S.running_peak(df, ["k"], "i", "v").orderBy("i").collect()]
    assert peaks[:8] == [0, 1, 2, 3, 4, 5, 6, 6]


def test_prompts(spark):
    df = spark.createDataFrame([(" Do it ", " with this ", " done "), ("Do it", None, None)], "i string, c string, r string")
    a, b = df.select(P.plain_prompt(F.col("i"), F.col("c")).alias("p"), P.training_example(F.col("i"), F.col("c"), F.col("r"), "#").alias("t"), P.user_message(F.col("i"), F.col("c")).alias("u")).collect()
    assert a.p == "### Instruction:\nDo it\n\n### Context:\nwith this\n\n### Response:\n" and a.t == a.p + "done#" and a.u == "Do it\n\nContext:\nwith this"
    assert b.p == "### Instruction:\nDo it\n\n### Response:\n" and b.t == b.p + "#"


def test_supervised_rows_and_padding(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], [4, 5]), (0, [1], [2])], "b int, p array<int>, a array<int>")
    ids, labels = P.supervised(F.col("p"), F.col("a"), 4)
    rows = df.select("b", ids.alias("input_ids"), labels.alias("labels"))
    assert [(r.input_ids, r.labels) for r in rows.collect()] == [([2, 3, 4, 5], [-100, -100, 4, 5]), ([1, 2], [-100, 2])]
    for r in P.padded(rows, "b", 9).collect():
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == 8
        assert sum(r.attention_mask) == len([x for x in r.input_ids if x != 9])


def test_small_text_functions(spark):
    df = spark.createDataFrame([("eval_loss", "/a/b/", "c.s.m", "x" * 491)], "k string, p string, n string, v string")
    r = df.select(T.metric_key(F.col("k")).alias("k"), T.flat_path(F.col("p")).alias("p"), T.is_three_level(F.col("n")).alias("n"), T.truncated_param(F.col("v")).alias("v"), T.short_name(F.lit("o/m")).alias("s")).first()
    assert (r.k, r.p, r.n, len(r.v), r.v[-3:], r.s) == ("eval/loss", "a-b", True, 490, "...", "m")


def test_predictions_by_a_hook(spark):
    from lodestone.operators import evaluation

    def load():
        return lambda prompts: [f" {p.upper()} " for p in prompts]

    got = evaluation.predict(spark.createDataFrame([(1, "a"), (2, None)], "i int, prompt string"), load).orderBy("i").collect()
    assert [r.prediction for r in got] == ["A", ""]
    with pytest.raises(RuntimeError):
        evaluation.train(print)


def test_report_parts_that_were_not_measured(spark):
    from lodestone.operators import evaluation

    q = spark.createDataFrame([("a", 0.5), ("b", 0.4)], "run string, rouge_l double")
    lat = spark.createDataFrame([("a", 10.0)], "run string, p95_ms double")
    r = evaluation.report("run", q, lat)
    assert evaluation.as_metrics(r, "run").count() == 3
    assert {x.run_id: x.latency_ms for x in evaluation.candidates_from_report(r, "run").collect()} == {"a": 10.0, "b": 0.0}

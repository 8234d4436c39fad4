from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.config import SelectionConfig
from lodestone.operators import quality as Q
from lodestone.operators import records as R
from lodestone.operators import selection
from tests.test_selection import table

LOOSE = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXTS = st.lists(st.tuples(st.text("ab the,. é", max_size=12), st.text("ab the,. é", max_size=12)), min_size=1, max_size=30)


@given(TEXTS)
@LOOSE
def test_scores_are_bounded_and_f1_is_symmetric(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "_idx bigint, prediction string, reference string")
    there = {r._idx: r for r in Q.scored(df).collect()}
    back = {r._idx: r for r in Q.scored(df.select("_idx", F.col("reference").alias("prediction"), F.col("prediction").alias("reference"))).collect()}
    for i, r in there.items():
        assert 0.0 <= r.rouge_l <= r.token_f1 + 1.0 and 0.0 <= r.token_f1 <= 1.0 and r.rouge_l <= 1.0 + 1e-9
        assert abs(r.token_f1 - back[i].token_f1) < 1e-9 and r.exact_match == back[i].exact_match
        assert r.exact_match == 0.0 or r.rouge_l > 1 - 1e-9


@given(st.lists(st.tuples(st.text("ab \x07", max_size=12), st.text("ab ", max_size=6)), max_size=25))
@LOOSE
def test_books_balance(spark, rows):
    df = R.normalize(spark.createDataFrame([(i, str(i), a, "", b, "") for i, (a, b) in enumerate(rows)], "_idx bigint, id string, instruction string, context string, response string, category string"), "t")
    j = R.judged(df)
    s, drops = R.validation_summary(j).first(), R.drop_counts(j).collect()
    assert s.input == len(rows) == s.kept + s.dropped and s.dropped == sum(r.n for r in drops)
    kept = R.kept(df)
    assert kept.select("content_hash").distinct().count() == s.kept


@given(st.floats(0.1, 50))
@LOOSE
def test_utility_does_not_change_with_the_scale_of_weights(spark, scale):
    c = table(spark, {"quality": 0.9, "latency_ms": 50.0}, {"quality": 0.4, "memory_mb": 10.0}, {"quality": 0.5})
    w = SelectionConfig().weights
    a = selection.with_utility(selection.normalized(c)).orderBy("_idx").collect()
    b = selection.with_utility(selection.normalized(c), SelectionConfig(weights={k: v * scale for k, v in w.items()})).orderBy("_idx").collect()
    assert all(abs(x.utility - y.utility) < 1e-9 for x, y in zip(a, b))

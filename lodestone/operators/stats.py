"""Rank-pick percentiles and the summaries built on them."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.numeric import trainable_pct


# The class of weight tensors that pack two weights in an element (fixed value).
PACKED = "Params4bit"
# Bins per doubling of a value.
FINE = 256


def _bin(v: Column) -> Column:
    """A number that never falls where the value grows; equal values share it. Infinities and NaN count as the largest."""
    x = F.nanvl(v.cast("double"), F.lit(sys.float_info.max))
    x = F.greatest(F.least(x, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))
    # Logarithms reach from -1,074 to 1,024, so positive values stay above 0 with this added.
    size = F.floor(F.log2(F.abs(x)) * FINE) + 2000 * FINE
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0).cast("bigint"))


def at_ranks(df: DataFrame, by: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """For each group the value at sorted position ``ranks[name](n)``, counted from 0, of its ``n`` non-null values.

    Two passes. The first counts values in bins, with map-side combine; a running count over a group's bins (some
    thousands, whatever the data) finds the bin of each rank. The second looks only at the values of these bins. So no
    task sees all values of a group. Without groups and values the result is one row of 0.0; values come back as doubles.
    """
    v = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"), _bin(F.col(value)).alias("_b"))
    bins = v.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_k"))
    upto = F.sum("_k").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_k").over(Window.partitionBy(*by))
    bins = bins.select(*by, "_b", (upto - F.col("_k")).alias("_before"), upto.alias("_upto"), total.alias("_n"))
    place = {name: F.least(rank(F.col("_n")).cast("bigint"), F.col("_n") - 1) for name, rank in ranks.items()}
    inside = {name: (F.col("_before") <= p) & (p < F.col("_upto")) for name, p in place.items()}
    met = bins.where(reduce(or_, inside.values())).select(
        *[F.col(c).alias(f"_g{k}") for k, c in enumerate(by)], F.col("_b").alias("_mb"), *[F.when(hit, place[name] - F.col("_before")).alias(f"_at_{name}") for name, hit in inside.items()]
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_g{k}")) for k, c in enumerate(by)], F.col("_b") == F.col("_mb"))
    near = v.join(met, same).groupBy(*by, "_b", "_v", *[f"_at_{x}" for x in ranks]).agg(F.count(F.lit(1)).alias("_k"))
    run = near.withColumn("_upto", F.sum("_k").over(Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    found = [F.min(F.when(F.col("_upto") > F.col(f"_at_{x}"), F.col("_v"))).cast("double").alias(x) for x in ranks]
    out = run.groupBy(*by).agg(*found) if by else run.agg(*found)
    return out if by else out.na.fill(0.0)


def rank_pick(df: DataFrame, by: list[str], value: str, picks: dict[str, float], mode: str) -> DataFrame:
    """For each group the values at sorted position floor(q(n-1)) (``mode='floor'``) or round-half-even(q(n-1))."""

    def rank(q: float) -> Callable[[Column], Column]:
        return lambda n: F.floor(F.lit(q) * (n - 1)) if mode == "floor" else F.bround(F.lit(q) * (n - 1), 0)

    return at_ranks(df, by, value, {name: rank(q) for name, q in picks.items()})


def latency_summary(df: DataFrame, by: list[str], ms: str, tokens: str | None = None, batch: int = 1) -> DataFrame:
    """Mean, interpolated median, p95 and p99 by rounded rank, extremes, sample deviation, tokens per second."""
    d = df.where(F.col(ms).isNotNull())
    new = F.avg(tokens) if tokens else F.lit(0.0)
    base = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(ms).alias("mean_ms"),
        F.min(ms).alias("min_ms"),
        F.max(ms).alias("max_ms"),
        F.coalesce(F.stddev_samp(ms), F.lit(0.0)).alias("std_ms"),
        new.alias("_tokens"),
    )
    tps = F.when(F.col("mean_ms") > 0, F.col("_tokens") * batch / (F.col("mean_ms") / 1000.0)).otherwise(F.lit(0.0))
    rounded = lambda q: lambda n: F.bround(F.lit(q) * (n - 1), 0)
    ranks = at_ranks(d, by, ms, {"_lo": lambda n: F.floor((n - 1) / 2), "_hi": lambda n: F.ceil((n - 1) / 2), "p95_ms": rounded(0.95), "p99_ms": rounded(0.99)})
    ranks = ranks.withColumn("median_ms", F.col("_lo") + (F.col("_hi") - F.col("_lo")) / 2).drop("_lo", "_hi")
    return base.withColumn("tokens_per_second", tps).drop("_tokens").join(ranks, by)


def perplexity(df: DataFrame, by: list[str], loss: str, tokens: str) -> DataFrame:
    """exp of the token-weighted mean loss, capped at 20; infinite without tokens."""
    g = df.groupBy(*by).agg(F.coalesce(F.sum(F.col(loss) * F.col(tokens)), F.lit(0.0)).alias("_l"), F.coalesce(F.sum(tokens), F.lit(0.0)).alias("tokens"))
    mean = F.when(F.col("tokens") > 0, F.col("_l") / F.col("tokens"))
    return g.select(*by, "tokens", mean.alias("mean_loss"), F.when(F.col("tokens") > 0, F.exp(F.least(mean, F.lit(20.0)))).otherwise(F.lit(float("inf"))).alias("perplexity"))


def running_peak(df: DataFrame, by: list[str], step: str, value: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(*by, step, value, F.max(value).over(w).alias("peak"))


def last_value(df: DataFrame, by: list[str], step: str, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.max_by(value, step).alias("last"))


def throughput_curve(df: DataFrame, by: list[str], size: str, failed: str) -> DataFrame:
    """The measurements below the first batch size that ran out of memory."""
    first = df.where(F.col(failed)).groupBy(*by).agg(F.min(size).alias("_oom"))
    return df.join(first, by, "left").where(F.col("_oom").isNull() | (F.col(size) < F.col("_oom"))).drop("_oom")


def newest(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The last n rows of each group. Ranking happens per slice of a group first, so a hot group meets many tasks."""
    salt = F.pmod(F.xxhash64(*df.columns[:1]), F.lit(64))
    first = df.withColumn("_s", salt).withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_s").orderBy(*order))).where(F.col("_r") <= n)
    return first.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= n).drop("_s", "_r")


def request_metrics(df: DataFrame, by: list[str], latency: str, failed, order: list, tokens: str | None = None, window: int = 1000) -> DataFrame:
    """Counters over all requests; mean and p95 latency of the last ``window`` of each group."""
    extra = [F.coalesce(F.sum(tokens), F.lit(0)).cast("bigint").alias("tokens")] if tokens else []
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"), F.count_if(failed).alias("errors"), *extra)
    last = newest(df.where(F.col(latency).isNotNull()), by, order, window)
    mean = last.groupBy(*by).agg(F.avg(latency).alias("mean_ms"))
    return counts.join(mean, by, "left").join(rank_pick(last, by, latency, {"p95_ms": 0.95}, "round"), by, "left")


def parameter_totals(parameters: DataFrame, by: list[str]) -> DataFrame:
    """Totals of a table of weight tensors (numel, element_size, kind, trainable, buffer).

    Weights packed in four bits hold two a stored element. Buffers count for the bytes only. Null counts are none.
    """
    n = F.coalesce(F.col("numel").cast("bigint"), F.lit(0).cast("bigint"))
    held = F.when(F.coalesce("buffer", F.lit(False)), F.lit(0).cast("bigint")).when(F.col("kind") == PACKED, n * 2).otherwise(n)
    g = parameters.groupBy(*by).agg(
        F.sum(held).alias("params_total"),
        F.sum(F.when(F.coalesce("trainable", F.lit(False)), held).otherwise(F.lit(0).cast("bigint"))).alias("params_trainable"),
        F.sum(n * F.coalesce(F.col("element_size").cast("bigint"), F.lit(0).cast("bigint"))).alias("bytes"),
    )
    total, part = F.col("params_total"), F.col("params_trainable")
    return g.withColumn("params_frozen", total - part).withColumn("params_trainable_pct", trainable_pct(part, total)).withColumn("size_mb", F.col("bytes") / 1048576)

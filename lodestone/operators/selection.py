"""From a table of runs to a champion: normalisation, utility, gates, ranking, Pareto frontier, comparison tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.config import SelectionConfig
from lodestone.functions.numeric import finite

# Axis, column, and whether more is better (fixed values).
AXES = (("quality", "quality", True), ("latency", "latency_ms", False), ("memory", "memory_mb", False), ("model_size", "model_size_mb", False), ("cost", "cost_per_1k_usd", False))


def candidates(runs: DataFrame) -> DataFrame:
    """Runs with a measured quality; other axes that are missing or not finite count as 0."""
    c = runs.where(finite(F.col("quality")))
    for _, col, _ in AXES[1:]:
        c = c.withColumn(col, F.when(finite(F.col(col)), F.col(col)).otherwise(F.lit(0.0)))
    return c.withColumn("method", F.lower("method")).withColumn("is_baseline", F.coalesce("is_baseline", F.lit(False)))


def normalized(c: DataFrame) -> DataFrame:
    """``n_<axis>`` in [0, 1] over all candidates, baseline and rejected included; a flat axis is 1 for all.

    The extremes are one aggregated row that is broadcast, not a window over everything.
    """
    ends = c.agg(*[f(col).alias(f"_{k}_{col}") for _, col, _ in AXES for k, f in (("lo", F.min), ("hi", F.max))])
    d = c.crossJoin(F.broadcast(ends))
    for axis, col, more in AXES:
        lo, hi = F.col(f"_lo_{col}"), F.col(f"_hi_{col}")
        up = (F.col(col) - lo) if more else (hi - F.col(col))
        d = d.withColumn(f"n_{axis}", F.when(hi - lo < 1e-12, 1.0).otherwise(up / (hi - lo)))
    return d.drop(*[f"_{k}_{col}" for _, col, _ in AXES for k in ("lo", "hi")])


def with_utility(n: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """Weighted mean of the normalised axes; weights of unknown names only dilute."""
    total = sum(abs(w) for w in cfg.weights.values())
    u = F.lit(0.0)
    for axis, _, _ in AXES:
        if total > 0 and axis in cfg.weights:
            u = u + F.lit(cfg.weights[axis] / total) * F.col(f"n_{axis}")
    return n.withColumn("utility", u)


def baseline_row(c: DataFrame) -> DataFrame:
    """The first baseline in input order, one row at most."""
    return c.where("is_baseline").orderBy("_idx").limit(1)


def gated(c: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """``rejected_reasons``: codes of the gates a run fails. A baseline is only ever ``is_baseline``."""
    base = baseline_row(c).select(F.col("quality").alias("_bq"))
    d = c.join(F.broadcast(base), F.lit(True), "left")
    q, bq = F.col("quality"), F.col("_bq")
    gates = []
    below = (bq > 0) & (q / F.when(bq > 0, bq) < cfg.min_quality_ratio_vs_baseline)
    gate = F.when(below, "quality_ratio")
    if cfg.require_beats_baseline:
        gate = gate.when((bq > 0) & (q <= bq), "not_above_baseline")
    gates.append(gate)
    if cfg.max_latency_ms is not None:
        gates.append(F.when(F.col("latency_ms") > cfg.max_latency_ms, "latency"))
    if cfg.max_memory_mb is not None:
        gates.append(F.when(F.col("memory_mb") > cfg.max_memory_mb, "memory"))
    reasons = F.when(F.col("is_baseline"), F.array(F.lit("is_baseline"))).otherwise(F.array_compact(F.array(*gates)))
    return d.withColumn("rejected_reasons", reasons).drop("_bq")


def ranked(c: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """Eligible runs with ``rank``: utility at six digits, then the tie breaker, then input order."""
    e = gated(with_utility(normalized(c), cfg), cfg).where(F.size("rejected_reasons") == 0)
    return e.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.round("utility", 6)), F.col(cfg.tie_breaker), F.col("_idx"))))


def _undominated(better: np.ndarray) -> np.ndarray:
    """Which rows no other row dominates; every column is such that more is better. Memory grows with the frontier."""
    order = np.lexsort(-better.T[::-1])  # a row is only dominated by rows that come before it
    front: list[int] = []
    held = np.empty((0, better.shape[1]))
    for at in range(0, len(order), 1024):
        block = order[at : at + 1024]
        x = better[block]
        for other in (held, x):
            if len(other):
                ge = (other[None] >= x[:, None]).all(2)
                gt = (other[None] > x[:, None]).any(2)
                alive = ~(ge & gt).any(1)
                block, x = block[alive], x[alive]
                if not len(block):
                    break
        front += block.tolist()
        held = np.concatenate([held, x])
    keep = np.zeros(len(better), dtype=bool)
    keep[front] = True
    return keep


def _local_front(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for b in batches:
        held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        axes = np.column_stack([held[col].to_numpy() * (1 if more else -1) for _, col, more in AXES])
        held = held.filter(pa.array(_undominated(axes)))
    if held is not None:
        yield from held.combine_chunks().to_batches()


def pareto(c: DataFrame) -> DataFrame:
    """Runs other than baselines that no other such run dominates; gates play no part.

    Every partition keeps its own frontier; the frontiers are merged by a few tasks and then by one. Tasks hold
    frontiers, never all runs; the last holds the result.
    """
    d = c.where("not is_baseline")
    thin = d.select("_idx", *[F.col(col).cast("double").alias(col) for _, col, _ in AXES])
    schema = ", ".join(f"`{n}` {t}" for n, t in thin.dtypes)
    front = thin.mapInArrow(_local_front, schema)
    for parts in (8, 1):
        front = front.repartition(parts).mapInArrow(_local_front, schema)
    return d.join(front.select("_idx"), "_idx", "left_semi")


def status(c: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """All runs with utility, rank, status and whether they are on the frontier."""
    full = gated(with_utility(normalized(c), cfg), cfg)
    r = ranked(c, cfg).select("_idx", "rank")
    front = pareto(c).select("_idx", F.lit(True).alias("_on"))
    d = full.join(r, "_idx", "left").join(front, "_idx", "left")
    first = F.try_element_at("rejected_reasons", F.lit(1))
    s = F.when(F.col("rank") == 1, "champion").when(F.col("rank") == 2, "challenger").when(F.col("is_baseline"), "baseline").when(first.isNotNull(), F.concat(F.lit("rejected: "), first)).otherwise("-")
    return d.withColumn("status", s).withColumn("on_pareto_frontier", F.coalesce("_on", F.lit(False))).drop("_on")


def gains(c: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """One row: the champion's quality gain over the baseline and its speed-up; null where either is missing."""
    champion = ranked(c, cfg).where("rank = 1").select(F.col("run_id").alias("champion"), F.col("quality").alias("_q"), F.col("latency_ms").alias("_l"))
    base = baseline_row(c).select(F.col("run_id").alias("baseline"), F.col("quality").alias("_bq"), F.col("latency_ms").alias("_bl"))
    d = champion.join(base, F.lit(True), "full_outer")
    return d.select("champion", "baseline", (F.col("_q") - F.col("_bq")).alias("quality_gain"), F.when(F.col("_l") > 0, F.col("_bl") / F.when(F.col("_l") > 0, F.col("_l"))).alias("speedup"))


def relative_to_baseline(c: DataFrame) -> DataFrame:
    """Four ratios of every other run to the baseline; a zero on the baseline's side gives null."""
    base = baseline_row(c).select(*[F.col(col).alias(f"_b_{col}") for _, col, _ in AXES])
    d = c.where("not is_baseline").crossJoin(F.broadcast(base))
    digits = {"quality": 4, "latency_ms": 1, "memory_mb": 1, "model_size_mb": 1}
    cols = [F.round(F.round(F.col(k), n) / F.nullif(F.col(f"_b_{k}"), F.lit(0.0)), 3).alias(f"{k}_vs_baseline") for k, n in digits.items()]
    return d.select("run_id", "run_name", "method", *cols)


def experiment_results(c: DataFrame) -> DataFrame:
    """The published table. The frontier flag goes by run name, so runs that share a name share it."""
    names = pareto(c).select("run_name").where("run_name is not null").distinct().withColumn("_on", F.lit(True))
    d = c.join(names, "run_name", "left")
    return d.select(
        "run_name", "method", F.round("quality", 4).alias("quality"), F.round("latency_ms", 1).alias("latency_p95_ms"), F.round("memory_mb", 1).alias("peak_memory_mb"), F.round("model_size_mb", 1).alias("model_size_mb"),
        F.round("cost_per_1k_usd", 5).alias("cost_per_1k_usd"), "is_baseline", "run_id", "dataset_version", F.coalesce("_on", F.lit(False)).alias("on_pareto_frontier"),
    )


def by_quality(c: DataFrame, n: int | None = None) -> DataFrame:
    """Runs by falling quality; ties keep the order of the runs."""
    d = c.orderBy(F.desc("quality"), "_idx")
    return d if n is None else d.limit(n)


def against_best_quality(c: DataFrame, cfg: SelectionConfig = SelectionConfig()) -> DataFrame:
    """One row: the champion, the best quality among ranked runs, and what the champion gives up of it."""
    r = ranked(c, cfg)
    best = r.agg(F.max("quality").alias("best_quality"))
    return r.where("rank = 1").select(F.col("run_id").alias("champion"), F.col("quality").alias("champion_quality")).crossJoin(best).withColumn("given_up", F.col("best_quality") - F.col("champion_quality"))

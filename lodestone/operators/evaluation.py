"""Evaluation of runs: assembling measured frames into one report per run, and batch prediction behind a hook."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import numeric as N
from lodestone.operators.quality import METRICS, macro_means, scored
from lodestone.operators.runs import long_metrics
from lodestone.operators.stats import latency_summary


def latency_and_cost(log: DataFrame, by: str, ms: str, tokens: str, hourly_usd: float = 0.60, batch: int = 1) -> DataFrame:
    """Latency summary with costs. Costs come from the mean latency, selection looks at the 95th percentile."""
    s = latency_summary(log, [by], ms, tokens, batch)
    per_hour = N.requests_per_hour(F.col("mean_ms"), F.lit(batch))
    rate = F.lit(hourly_usd)
    return s.withColumn("requests_per_hour", per_hour).withColumn("cost_per_1k_usd", N.cost_per_1k(rate, per_hour)).withColumn("cost_per_1m_tokens_usd", N.cost_per_1m_tokens(rate, F.col("tokens_per_second")))


def first_of_each(df: DataFrame, by: str, n: int | None, idx: str = "_idx") -> DataFrame:
    """The first ``n`` rows of each run by ``idx`` (a limit of evaluation; all where null).

    Slices of a run keep their first n before the run's are chosen, so a run of any length meets many tasks.
    """
    if n is None:
        return df
    order = F.row_number().over(Window.partitionBy(by, "_s").orderBy(idx))
    part = df.withColumn("_s", F.pmod(F.xxhash64(idx), F.lit(64))).withColumn("_k", order).where(F.col("_k") <= n)
    return part.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(idx))).where(F.col("_k") <= n).drop("_s", "_k")


def quality_by_run(pairs: DataFrame, by: str, metrics: tuple[str, ...] = METRICS, n: int | None = None) -> DataFrame:
    """Mean scores of each run's predictions."""
    return macro_means(scored(first_of_each(pairs, by, n)), metrics, (by,)).withColumnRenamed("n", "num_eval_examples")


def memory_parts(df: DataFrame, by: str, peak: str, weights: str, total_mb: float) -> DataFrame:
    """Peak and weight megabytes of each run with what follows from them."""
    g = df.groupBy(by).agg(F.max(peak).alias("peak_memory_mb"), F.max(weights).alias("model_size_mb"))
    p, w = F.col("peak_memory_mb"), F.col("model_size_mb")
    return g.withColumn("activation_overhead_mb", N.activation_overhead_mb(p, w)).withColumn("utilization_pct", N.utilization_pct(p, F.lit(total_mb)))


def report(by: str, quality: DataFrame, latency: DataFrame | None = None, perplexity: DataFrame | None = None, memory: DataFrame | None = None) -> DataFrame:
    """One row per run from the frames that were measured; a part that was not is null."""
    r = quality
    for part in (latency, perplexity, memory):
        if part is not None:
            r = r.join(part, by, "left")
    return r


def as_metrics(report_: DataFrame, by: str) -> DataFrame:
    """The report as (run, key, value) rows; what was not measured has no row."""
    names = [c for c, t in report_.dtypes if c != by and t in ("double", "float", "int", "bigint")]
    wide = report_.select(by, *[F.col(c).cast("double").alias(c) for c in names])
    return long_metrics(wide, [by], names).where(F.col("value").isNotNull())


def candidates_from_report(report_: DataFrame, by: str, primary: str = "rouge_l") -> DataFrame:
    """The five axes of a run: primary metric, p95 latency, peak memory, size, cost; missing ones are 0."""
    have = set(report_.columns)
    pick = lambda c: F.coalesce(F.col(c), F.lit(0.0)) if c in have else F.lit(0.0)
    return report_.select(
        F.col(by).alias("run_id"), pick(primary).alias("quality"), pick("p95_ms").alias("latency_ms"), pick("peak_memory_mb").alias("memory_mb"), pick("model_size_mb").alias("model_size_mb"), pick("cost_per_1k_usd").alias("cost_per_1k_usd"),
    )


def predict(prompts: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], column: str = "prompt", batch: int = 8) -> DataFrame:
    """Predictions by a model that each worker loads once; batches of prompts, in an Arrow iterator."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in frames:
            texts = pdf[column].fillna("").tolist()
            out = [y.strip() for at in range(0, len(texts), batch) for y in model(texts[at : at + batch])]
            yield pdf.assign(prediction=out)

    return prompts.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in prompts.dtypes) + ", prediction string")


def train(function: Callable, processes: int = 1, gpu: bool = False, **arguments):
    """Run a training function on the cluster's workers; needs torch."""
    try:
        import torch  # noqa: F401
        from pyspark.ml.torch.distributor import TorchDistributor
    except ImportError as e:
        raise RuntimeError("training needs torch on the driver and the workers") from e
    return TorchDistributor(num_processes=processes, local_mode=False, use_gpu=gpu).run(function, **arguments)

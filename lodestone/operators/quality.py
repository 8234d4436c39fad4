"""Text-overlap scores of predictions against references, macro means and best/worst samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import answer_tokens, token_matches

BETA_SQUARED = 1.44
METRICS = ("exact_match", "token_f1", "rouge_l", "length_ratio")


def f_measure(common: Column, n_pred: Column, n_ref: Column, beta2: float = 1.0) -> Column:
    """Both empty 1, one empty 0, nothing in common 0; else (1 + b2) P R / (R + b2 P)."""
    p, r = common / n_pred, common / n_ref
    score = (1.0 + beta2) * p * r / (r + beta2 * p)
    return F.when((n_pred == 0) & (n_ref == 0), 1.0).when((n_pred == 0) | (n_ref == 0) | (common == 0), 0.0).otherwise(score)


def scored(pairs: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """The pairs with the four scores. Normalised once; the matching runs in one Arrow function."""
    t = pairs.withColumn("_p", answer_tokens(F.col(prediction))).withColumn("_r", answer_tokens(F.col(reference)))
    t = t.withColumn("_m", token_matches("_p", "_r"))
    np_, nr = F.size("_p"), F.size("_r")
    return t.select(
        *pairs.columns,
        (F.array_join("_p", " ") == F.array_join("_r", " ")).cast("double").alias("exact_match"),
        f_measure(F.col("_m.common"), np_, nr).alias("token_f1"),
        f_measure(F.col("_m.lcs"), np_, nr, BETA_SQUARED).alias("rouge_l"),
        F.when(nr == 0, 0.0).otherwise(np_ / nr).alias("length_ratio"),
    )


def paired(predictions: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """Strict 1:1 join; the unmatched rows are counted first and raise."""
    lone = predictions.select(*keys).join(references.select(*keys), keys, "left_anti").limit(1).count() + references.select(*keys).join(predictions.select(*keys), keys, "left_anti").limit(1).count()
    if lone:
        raise ValueError("predictions and references differ in length")
    return predictions.join(references, keys)


def macro_means(scores: DataFrame, metrics: tuple[str, ...] = METRICS, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean of each metric; ``length_ratio`` is always among them; without rows the requested metrics are 0."""
    if unknown := set(metrics) - set(METRICS):
        raise ValueError(f"unknown metrics: {', '.join(sorted(unknown))}")
    wanted = dict.fromkeys((*metrics, "length_ratio"))
    return scores.groupBy(*by).agg(*[F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in wanted], F.count(F.lit(1)).alias("n"))


def best_and_worst(scores: DataFrame, by: str, metric: str, idx: str = "_idx", worst: int = 10, best: int = 5) -> DataFrame:
    """The lowest and the highest scored rows of each run; with few rows one may be in both buckets.

    Each side is a top-k aggregate: slices of a run keep their own k before the run's k are chosen.
    """

    def top(order: list, k: int, bucket: str) -> DataFrame:
        s = scores.withColumn("_s", F.pmod(F.xxhash64(idx), F.lit(64)))
        s = s.withColumn("_k", F.row_number().over(Window.partitionBy(by, "_s").orderBy(*order))).where(F.col("_k") <= k)
        s = s.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_k") <= k)
        return s.drop("_s", "_k").withColumn("bucket", F.lit(bucket))

    return top([F.col(metric), F.col(idx)], worst, "worst").unionByName(top([F.desc(metric), F.desc(idx)], best, "best"))


def with_texts(samples: DataFrame, texts: DataFrame, idx: str = "_idx", columns: tuple[str, ...] = ("instruction", "reference", "prediction"), chars: int = 400) -> DataFrame:
    """The chosen samples with their texts, each cut to what a report shows. Texts of other rows are not moved."""
    shown = [F.substring(c, 1, chars).alias(c) for c in columns]
    # Some fifteen rows a run against all texts: the samples are the side that is sent around where they are few.
    return samples.join(texts.select(idx, *shown), idx)

"""Scalar arithmetic: costs, memory, step counts and roundings. Divisions are guarded as ANSI mode raises on zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def ratio(a: Column, b: Column, otherwise: float | None = 0.0) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(otherwise).cast("double"))


def requests_per_hour(ms: Column, batch: Column) -> Column:
    return F.when(ms > 0, F.lit(3600.0) / (ms / 1000.0) * batch).otherwise(F.lit(0.0))


def cost_per_request(rate: Column, per_hour: Column) -> Column:
    return F.when(per_hour > 0, rate / per_hour).otherwise(F.lit(INF))


def cost_per_1k(rate: Column, per_hour: Column) -> Column:
    return cost_per_request(rate, per_hour) * 1000.0


def cost_per_1m_tokens(rate: Column, tokens_per_second: Column) -> Column:
    return F.when(tokens_per_second > 0, rate / (tokens_per_second * 3600.0) * 1e6).otherwise(F.lit(INF))


def training_cost(seconds: Column, rate: Column) -> Column:
    return seconds / 3600.0 * rate


def activation_overhead_mb(peak: Column, weights: Column) -> Column:
    return F.greatest(peak - weights, F.lit(0.0))


def utilization_pct(peak: Column, total: Column) -> Column:
    return F.when(total > 0, peak / total * 100.0).otherwise(F.lit(0.0))


def trainable_pct(trainable: Column, total: Column) -> Column:
    return F.when(total > 0, trainable / total * 100.0).otherwise(F.lit(0.0))


def optimizer_steps(examples: Column, effective_batch: Column, epochs: Column, max_steps: Column) -> Column:
    per_epoch = F.ceil(examples / effective_batch)
    return F.when(max_steps > 0, max_steps.cast("bigint")).otherwise(F.greatest(F.lit(1).cast("bigint"), F.ceil(per_epoch * epochs).cast("bigint")))


def cpu_minutes(steps: Column, effective_batch: Column, seq_length: Column, checkpointing: Column) -> Column:
    """Estimated CPU training time: ten minutes a step at batch 16 and length 1024, a quarter less without checkpointing."""
    scale = (effective_batch / 16.0) * (seq_length / 1024.0) * F.when(checkpointing, 1.0).otherwise(0.75)
    return steps * 10.0 * F.greatest(scale, F.lit(0.05))


def warmup_steps(share: Column, steps: Column) -> Column:
    return F.bround(share * steps, 0).cast("bigint")


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(INF))

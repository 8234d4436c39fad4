"""Streaming forms of the three online accumulators: request counters with a bounded window, metrics, drop counts."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestone.config import DataConfig
from lodestone.operators.records import failed_rule
from lodestone.operators.runs import finite_metrics
from lodestone.session import new_path

WINDOW = 1000
OUTPUT = "name string, requests bigint, errors bigint, tokens bigint, mean_ms double, p95_ms double, held int"
PEAKS = "run_id string, step bigint, value double, peak double"


def tail_value(values: list[float], share: float = 0.95) -> float:
    """The smallest of the values in the upper tail behind position round(share (n - 1)); 0 without values."""
    if not values:
        return 0.0
    behind = len(values) - round(share * (len(values) - 1))
    return heapq.nlargest(behind, values)[-1]


class LastRequests(StatefulProcessor):
    """Per name: counters over all requests, and the latencies of the latest ones, never more than the window.

    The latest are those of the highest (at, seq), so late rows and the order within a batch do not matter.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", "requests bigint, errors bigint, tokens bigint")
        self.recent = handle.getListState("recent", "at timestamp, seq bigint, ms double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        requests, errors, tokens = self.counts.get() if self.counts.exists() else (0, 0, 0)
        held = [tuple(r) for r in self.recent.get()]
        for pdf in rows:
            requests += len(pdf)
            errors += int(pdf["failed"].sum())
            tokens += int(pdf["tokens"].sum())
            new = pdf.dropna(subset=["ms", "at"])
            held += zip(map(pd.Timestamp.to_pydatetime, new["at"]), new["seq"].tolist(), new["ms"].tolist())
            held = heapq.nlargest(WINDOW, held)
        self.counts.update((requests, errors, tokens))
        self.recent.put(held)
        ms = [x for _, _, x in held]
        yield pd.DataFrame({"name": [key[0]], "requests": [requests], "errors": [errors], "tokens": [tokens], "mean_ms": [sum(ms) / len(ms) if ms else 0.0], "p95_ms": [tail_value(ms)], "held": [len(ms)]})

    def close(self) -> None:
        pass


def request_metrics(stream: DataFrame) -> DataFrame:
    """Stream (name, at, seq, ms, failed, tokens) to running metrics per name. Needs the RocksDB state store."""
    # The runner that sets the processor up on the driver does not see files shipped to executors: send the code itself.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return stream.groupBy("name").transformWithStateInPandas(statefulProcessor=LastRequests(), outputStructType=OUTPUT, outputMode="Update", timeMode="None")


class RunningPeak(StatefulProcessor):
    """Per run: every step with the highest value up to it. Steps that come late do not lower what was already sent."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.peak = handle.getValueState("peak", "value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values("step")
        before = self.peak.get()[0] if self.peak.exists() else float("-inf")
        peaks = pdf["value"].cummax().clip(lower=before).ffill()
        top = max(before, pdf["value"].max()) if pdf["value"].notna().any() else before
        if top > float("-inf"):
            self.peak.update((float(top),))
        yield pd.DataFrame({"run_id": key[0], "step": pdf["step"], "value": pdf["value"], "peak": peaks})

    def close(self) -> None:
        pass


def running_peaks(stream: DataFrame) -> DataFrame:
    """Stream (run_id, step, value) to the same rows with the peak so far. Needs the RocksDB state store."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return stream.groupBy("run_id").transformWithStateInPandas(statefulProcessor=RunningPeak(), outputStructType=PEAKS, outputMode="Append", timeMode="None")


def forward_metrics(stream: DataFrame, path: str, checkpoint: str):
    """Append every micro-batch of (run_id, key, value, step, ts) to the metric table; non-finite values are dropped."""
    return (
        stream.writeStream.foreachBatch(lambda df, _: finite_metrics(df).write.mode("append").parquet(path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drop_counts(stream: DataFrame, config: DataConfig = DataConfig()) -> DataFrame:
    """Running counts of records per broken rule, and of those kept, over a stream of canonical records."""
    return stream.withColumn("reason", F.coalesce(failed_rule(config), F.lit("kept"))).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def run_to_table(stream: DataFrame, mode: str) -> DataFrame:
    """Everything the stream has now, run to its end, as a table in the shared folder.

    Micro-batches are appended as files, so no result gathers on the driver; where the whole result is sent each time,
    the last batch replaces the others.
    """
    spark = stream.sparkSession
    path = new_path(spark, "stream")
    write = "overwrite" if mode == "complete" else "append"
    query = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: df.write.mode(write).parquet(path)).option("checkpointLocation", f"{path}-state").trigger(availableNow=True)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query.start().awaitTermination()
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    return spark.read.schema(stream.schema).parquet(path)

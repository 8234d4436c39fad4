"""Run store and model registry as plain append-only tables."""

from __future__ import annotations

import importlib
import json
import logging
import os
import platform
import random
import subprocess
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.numeric import finite

RUNS = "run_id string, run_name string, status string, start_time timestamp, tags map<string,string>, params map<string,string>"
METRICS = "run_id string, key string, value double, step bigint, ts timestamp"
VERSIONS = "model string, version bigint, run_id string, description string, ts timestamp"
ALIASES = "model string, alias string, version bigint, ts timestamp"
ARTIFACTS = "run_id string, path string, content string, ts timestamp"
TABLES = {"runs": RUNS, "metrics": METRICS, "versions": VERSIONS, "aliases": ALIASES, "artifacts": ARTIFACTS}
# Optional packages whose versions a snapshot of the environment names.
PACKAGES = ("pyspark", "pyarrow", "pandas", "numpy", "torch", "transformers", "peft", "datasets", "bitsandbytes")
log = logging.getLogger(__name__)


def finite_metrics(metrics: DataFrame) -> DataFrame:
    """What the metric sink writes: NaN and infinities are dropped."""
    return metrics.where(finite(F.col("value").cast("double"))).withColumn("value", F.col("value").cast("double"))


def long_metrics(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Wide measurements as (key, value) rows."""
    return df.unpivot(by, columns, "key", "value")


def latest_metrics(metrics: DataFrame, by: str = "run_id", order: tuple[str, ...] = ("step", "ts")) -> DataFrame:
    return metrics.groupBy(by, "key").agg(F.max_by("value", F.struct(*order)).alias("value"))


def candidates_from_runs(runs: DataFrame, metrics: DataFrame, keys: dict[str, str], primary: str, limit: int = 200) -> DataFrame:
    """Finished runs, newest ``limit``, that have the primary metric; each key's latest value, 0 where missing."""
    done = runs.where("status = 'FINISHED'").orderBy(F.desc("start_time"), "run_id").limit(limit)
    latest = latest_metrics(finite_metrics(metrics))
    wide = latest.groupBy("run_id").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(name) for name, k in keys.items()])
    c = done.join(wide, "run_id").where(F.col(primary).isNotNull())
    return c.select("run_id", "run_name", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in keys], F.coalesce(F.col("tags")["arm"] == "baseline", F.lit(False)).alias("is_baseline"), F.col("tags").alias("metadata"))


def current_versions(aliases: DataFrame) -> DataFrame:
    """What every alias points to: its latest assignment."""
    return aliases.groupBy("model", "alias").agg(F.max_by("version", F.struct("ts", "version")).alias("version"))


def git_commit(folder: str = ".") -> str:
    """Short commit of the working tree, marked if it has changes; 'unknown' outside a repository."""
    run = lambda *a: subprocess.run(["git", "-C", folder, *a], capture_output=True, text=True, timeout=10)
    try:
        head = run("rev-parse", "--short", "HEAD")
        if head.returncode:
            return "unknown"
        return head.stdout.strip() + ("-dirty" if run("status", "--porcelain").stdout.strip() else "")
    except (OSError, subprocess.TimeoutExpired):
        return "unknown"


def environment() -> dict[str, str]:
    """What about this machine and its packages could change a number."""
    found = {"python": platform.python_version(), "platform": platform.platform(terse=True), "processor": platform.processor() or "unknown", "git_commit": git_commit()}
    for name in PACKAGES:
        try:
            found[name] = importlib.import_module(name).__version__
        except (ImportError, AttributeError):
            found[name] = "not installed"
    return found


def seed_everything(seed: int) -> int:
    """Seed the driver's generators. Engine-side draws are hashes of keys and seed, so they need none."""
    random.seed(seed)
    os.environ["PYTHONHASHSEED"] = str(seed)
    for name, plant in (("numpy", lambda m: m.random.seed(seed)), ("torch", lambda m: m.manual_seed(seed))):
        try:
            plant(importlib.import_module(name))
        except ImportError:
            continue
    return seed


def numbers(prefix: str, values: dict[str, Any], digits: dict[str, int] | None = None) -> dict[str, float]:
    """The numeric ones of measured values as metrics ``prefix/name``, rounded where ``digits`` says so."""
    shown = {k: float(v) for k, v in values.items() if isinstance(v, int | float) and not isinstance(v, bool)}
    return {f"{prefix}/{k}": round(v, digits[k]) if digits and k in digits else v for k, v in shown.items()}


def merged_tags(base: dict[str, str], config: dict[str, str], extra: dict[str, str]) -> dict[str, str]:
    return {**base, **config, **extra}


class Store:
    """Five append-only parquet tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _file_system(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def table(self, name: str) -> DataFrame:
        fs, p = self._file_system(self._path(name))
        if not fs.exists(p):
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(self._path(name))

    def append(self, name: str, df: DataFrame) -> None:
        (finite_metrics(df) if name == "metrics" else df).write.mode("append").parquet(self._path(name))

    def _row(self, name: str, *values: Any) -> None:
        self.append(name, self.spark.createDataFrame([(*values, datetime.now(UTC).replace(tzinfo=None))], TABLES[name]))

    def tolerant(self, write: Callable[[], None], what: str) -> bool:
        """Bookkeeping must not end a run: a failed write is logged as a warning."""
        try:
            write()
        except Exception as e:  # noqa: BLE001
            log.warning("could not log %s: %s", what, e)
            return False
        return True

    def start_run(self, run_id: str, name: str, tags: dict[str, str] | None = None, params: dict[str, str] | None = None, status: str = "FINISHED") -> None:
        row = (run_id, name, status, datetime.now(UTC).replace(tzinfo=None), tags or {}, params or {})
        self.append("runs", self.spark.createDataFrame([row], RUNS))

    def log_metrics(self, run_id: str, values: dict[str, float], step: int = 0) -> bool:
        now = datetime.now(UTC).replace(tzinfo=None)
        rows = [(run_id, k, float(v), step, now) for k, v in values.items() if v is not None]
        return self.tolerant(lambda: self.append("metrics", self.spark.createDataFrame(rows, METRICS)), f"metrics of {run_id}")

    def log_artifact(self, run_id: str, path: str, content: str) -> bool:
        return self.tolerant(lambda: self._row("artifacts", run_id, path, content), path)

    def log_fingerprint(self, run_id: str, fingerprint: dict[str, Any]) -> bool:
        """A data set's identity: numbers as metrics, everything as an artifact."""
        self.log_metrics(run_id, numbers("data", fingerprint))
        return self.log_artifact(run_id, "data/dataset_fingerprint.json", json.dumps(fingerprint, indent=2, default=str))

    def log_report(self, run_id: str, report: dict[str, Any], samples: str | None = None) -> bool:
        """An evaluation report's numbers as metrics, itself and its samples as artifacts."""
        self.log_metrics(run_id, numbers("eval", report))
        if samples:
            self.log_artifact(run_id, "evaluation/samples.md", samples)
        return self.log_artifact(run_id, "evaluation/evaluation_report.json", json.dumps(report, indent=2, default=str))

    def tags_of(self, run_id: str) -> dict[str, str]:
        """The tags of one run, for its card; none if there is no such run."""
        row = self.table("runs").where(F.col("run_id") == run_id).select("tags").first()
        return dict(row["tags"] or {}) if row else {}

    def register(self, model: str, run_id: str, description: str = "") -> int:
        """The next version of a model. A version is taken by creating its marker file, which only one writer can."""
        known = self.table("versions").where(F.col("model") == model).agg(F.max("version")).first()[0]
        version = (known or 0) + 1
        marker = uuid.uuid5(uuid.NAMESPACE_OID, model).hex
        while True:
            fs, p = self._file_system(f"{self.folder}/_taken/{marker}-{version}")
            try:
                fs.create(p, False).close()
                break
            except Exception:  # noqa: BLE001 - somebody else's version, unless the folder cannot be written
                if not fs.exists(p):
                    raise
                version += 1
        self._row("versions", model, version, run_id, description)
        return version

    def set_alias(self, model: str, alias: str, version: int) -> None:
        self._row("aliases", model, alias, version)

    def resolve(self, model: str, alias: str) -> int | None:
        row = current_versions(self.table("aliases").where((F.col("model") == model) & (F.col("alias") == alias))).first()
        return row["version"] if row else None

    def promote(self, model: str, champion: str | None, challenger: str | None = None, dry_run: bool = False) -> int | None:
        """Register a champion and point the alias at it; nothing happens without one or in a dry run."""
        if not champion or dry_run:
            return None
        version = self.register(model, champion)
        self.set_alias(model, "champion", version)
        if challenger:
            self.set_alias(model, "challenger", self.register(model, challenger))
        return version

    def rollback(self, model: str, version: int, alias: str = "champion") -> None:
        if self.table("versions").where((F.col("model") == model) & (F.col("version") == version)).isEmpty():
            raise ValueError(f"{model} has no version {version}")
        self.set_alias(model, alias, version)


def model_uri(name: Column | str, alias: Column | str | None = None, version: Column | int | None = None) -> Column:
    """``models:/name@alias``, or ``models:/name/version`` without an alias; of columns or plain values."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    tail = F.concat(F.lit("@"), lit(alias)) if alias is not None else F.concat(F.lit("/"), lit(version).cast("string"))
    return F.concat(F.lit("models:/"), lit(name), tail)


def run_uri(run_id: Column | str, path: str) -> Column:
    return F.concat(F.lit("runs:/"), run_id if isinstance(run_id, Column) else F.lit(run_id), F.lit(f"/{path}"))

"""Session construction and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "lodestone", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session with the settings every operator here is tested with."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{n}]").appName(app_name)
    settings = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a folder of our own where that is unset (local runs)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lodestone-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = "file://" + folder
        spark.sparkContext.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder. The application's own folder there is deleted when the driver ends."""
    app = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    if app not in _folders:
        _folders.add(app)
        p = spark._jvm.org.apache.hadoop.fs.Path(app)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        # The file system's own hook runs when the driver's process ends, however many tables are left by then.
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{app}/{name}-{uuid.uuid4().hex}"


_folders: set[str] = set()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and lets several consumers read one result; a lost executor costs nothing because the files do
    not live on executors.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_lines(lines: DataFrame) -> str:
    """The path of ``lines`` (one string column) written as compressed text files, one a partition; their names keep the order of the partitions."""
    path = new_path(lines.sparkSession, "lines")
    lines.write.text(path, compression="gzip")
    return path


def forget(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for f in {unquote(x.rsplit("/", 1)[0]) for x in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(conf).delete(p, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        here = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="lodestone-ship-")  # read by the driver's own file server only
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{here.name}", "zip", here.parent, here.name))

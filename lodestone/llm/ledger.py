"""Records that differ only in formatting, counted in an incremental ledger (problem 1).

Method: every record gets a canonical key; a batch is aggregated by key, full-outer-joined against the ledger inside
matching buckets, counts are added and the earliest row stays the representative. The ledger is a stored table, one
folder a bucket of keys: a batch reads and rewrites the buckets its keys fall into and leaves all others as they are.

Two keys describe a record. The *plain* key is the digest of the letters and digits of the three fields. Where a field
is a JSON object or only lines of ``name: value``, the *structured* key is the digest with that field's pairs sorted.
A ledger row stands for one plain key; rows whose structured keys agree form one group, and a plain key seen without
structure (line ends lost) takes the structured key of the equally lettered record.

Defined cases: null equals empty equals "no letters or digits"; a record with three empty fields is a record like any
other, so all such rows form one group; ties cannot occur as ``_idx`` is unique, and rows repeated with the same
``_idx`` count as copies but never yield a (keep, copy) row with equal ids; an empty batch leaves the ledger as it is;
other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import materialize, new_path

FIELDS = ("instruction", "context", "response")
BUCKETS = 64
LEDGER_SCHEMA = "bucket int, plain_key binary, struct_key binary, copies bigint, keep_idx bigint"


def letters(c: Column) -> Column:
    """Letters and digits only, case folded through upper case (so that sharp s equals double s)."""
    return F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def _pairs(names: Column) -> Column:
    return F.concat_ws("", F.lit("\u0001"), F.array_join(F.array_sort(names), "\u0001"))


def structured(c: Column) -> Column:
    """The field's canonical letters with its pairs in sorted order, or null where it is not made of pairs."""
    text = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n"))
    entries = F.map_entries(F.from_json(text, "map<string,string>"))
    as_json = F.when(
        text.rlike(r"(?s)^\s*\{.*\}\s*$") & entries.isNotNull(),
        _pairs(F.transform(entries, lambda e: F.concat(letters(e["key"]), letters(e["value"])))),
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\S"))
    paired = F.forall(lines, lambda x: x.rlike(r"^[^\p{L}\p{N}:]*[\p{L}\p{N}][^:]*:.*[\p{L}\p{N}]"))
    as_lines = F.when(
        text.contains(":") & text.contains("\n") & (F.size(lines) > 1) & paired,
        _pairs(F.transform(lines, lambda x: letters(x))),
    )
    return F.coalesce(as_json, as_lines)


def _digest(parts: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws("\u001f", *parts)))


def keyed(df: DataFrame, idx: str = "_idx", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record: ``idx, plain_key, struct_key`` (null where no field is structured) and the ``keep`` columns."""
    plain = {f: letters(F.col(f)) for f in FIELDS}
    maybe = {f: F.when(F.col(f).contains(":"), structured(F.col(f))) for f in FIELDS}
    picked = df.select(F.col(idx).alias("idx"), *keep, *[plain[f].alias(f"_p_{f}") for f in FIELDS], *[maybe[f].alias(f"_s_{f}") for f in FIELDS])
    any_structure = F.coalesce(*[F.col(f"_s_{f}") for f in FIELDS]).isNotNull()
    return picked.select(
        "idx",
        *keep,
        _digest([F.col(f"_p_{f}") for f in FIELDS]).alias("plain_key"),
        F.when(any_structure, _digest([F.coalesce(F.col(f"_s_{f}"), F.col(f"_p_{f}")) for f in FIELDS])).alias("struct_key"),
    )


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


class Ledger:
    """A ledger on shared storage that grows batch by batch.

    ``folder/gen-N/bucket=B`` holds bucket B as batch N left it. Which generation of each bucket is current stands in
    ``folder/current-N``, written last, so a batch that fails changes nothing and readers see whole batches only. One
    writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _current(self) -> tuple[int, dict[int, int]]:
        """The last batch and the generation of each bucket (at most ``BUCKETS`` numbers)."""
        fs, p = self._fs(f"{self.folder}/current-*")
        done = [int(f.getPath().getName().split("-")[1]) for f in (fs.globStatus(p) or []) if not f.isDirectory()]
        if not done:
            return 0, {}
        text = self.spark.read.text(f"{self.folder}/current-{max(done)}", wholetext=True).first()[0]
        return max(done), {int(b): g for b, g in json.loads(text).items()}

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All of the ledger, or some buckets of it."""
        paths = [f"{self.folder}/gen-{g}/bucket={b}" for b, g in sorted(self._current()[1].items()) if buckets is None or b in buckets]
        if not paths:
            return empty_ledger(self.spark)
        held = self.spark.read.schema(LEDGER_SCHEMA.split(", ", 1)[1]).parquet(*paths)
        return held.select(_bucket(F.col("plain_key")).alias("bucket"), *held.columns)

    def add(self, batch: DataFrame) -> None:
        """One more batch, from :func:`summarize`."""
        batch = materialize(batch, "p1-batch")
        touched = [r.bucket for r in batch.select("bucket").distinct().collect()]
        if not touched:
            return
        last, current = self._current()
        # A new generation of the touched buckets; the old one stays for readers that began before.
        grown = update(self.read(touched), batch)
        # One file a bucket where buckets are small; large ones are split.
        grown.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.folder}/gen-{last + 1}")
        fs, p = self._fs(f"{self.folder}/writing-{last + 1}")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps({str(b): g for b, g in (current | dict.fromkeys(touched, last + 1)).items()}).encode()))
        out.close()
        if not fs.rename(p, self._fs(f"{self.folder}/current-{last + 1}")[1]):
            raise RuntimeError("another writer added a batch to this ledger")


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def summarize(keys: DataFrame) -> DataFrame:
    """Ledger rows of one batch; counts combine map-side, so a key holding a third of all rows costs one row a task."""
    return keys.groupBy("plain_key").agg(
        F.min("struct_key").alias("struct_key"), F.count(F.lit(1)).alias("copies"), F.min("idx").alias("keep_idx")
    ).select(_bucket(F.col("plain_key")).alias("bucket"), "plain_key", "struct_key", "copies", "keep_idx")


def update(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """The ledger after one more batch. ``batch`` comes from :func:`summarize`.

    Both sides hold one row per key, so the join cannot be skewed however hot a key is in the data.
    """
    a, b = ledger.alias("a"), batch.alias("b")
    on = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.plain_key") == F.col("b.plain_key"))
    return a.join(b, on, "full_outer").select(
        F.coalesce("a.bucket", "b.bucket").alias("bucket"),
        F.coalesce("a.plain_key", "b.plain_key").alias("plain_key"),
        F.least("a.struct_key", "b.struct_key").alias("struct_key"),
        (F.coalesce("a.copies", F.lit(0)) + F.coalesce("b.copies", F.lit(0))).cast("bigint").alias("copies"),
        F.least("a.keep_idx", "b.keep_idx").alias("keep_idx"),
    )


def groups(ledger: DataFrame) -> DataFrame:
    """``group_key, copies, keep_idx``: one row per record with the number of its copies, over all batches."""
    return ledger.groupBy(F.coalesce("struct_key", "plain_key").alias("group_key")).agg(
        F.sum("copies").alias("copies"), F.min("keep_idx").alias("keep_idx")
    )


def classes(keys: DataFrame, ledger: DataFrame, hot: int = 1000) -> DataFrame:
    """The rows of ``keys`` with ``first_idx``, the earliest row of their group; groups of one are left out.

    A key that holds more than one row in ``hot`` of all is one of fewer than ``hot`` such keys, so these are sent to
    every task; all others are joined by key, and none of them is large.
    """
    repeated = groups(ledger).where("copies > 1").select("group_key", F.col("keep_idx").alias("first_idx"))
    to_first = ledger.select("plain_key", F.coalesce("struct_key", "plain_key").alias("group_key"), F.col("copies").alias("own")).join(repeated, "group_key")
    total = ledger.agg(F.sum("copies").alias("total"))
    to_first = materialize(to_first.crossJoin(F.broadcast(total)).select("plain_key", "first_idx", (F.col("own") * hot > F.col("total")).alias("is_hot")), "p1-first")
    few = to_first.where("is_hot").select("plain_key", F.col("first_idx").alias("hot_idx"))
    marked = keys.join(F.broadcast(few), "plain_key", "left")
    rest = marked.where("hot_idx is null").drop("hot_idx").join(to_first.where("not is_hot").drop("is_hot"), "plain_key")
    return marked.where("hot_idx is not null").withColumnRenamed("hot_idx", "first_idx").unionByName(rest)


def build(df: DataFrame, late: Column) -> tuple[DataFrame, Ledger]:
    """Keys of all rows and a new ledger after two batches: rows delivered in time, then those delivered late."""
    keys = materialize(keyed(df.withColumn("_late", F.coalesce(late, F.lit(False))), keep=("_late",)), "p1-keys")
    ledger = Ledger(df.sparkSession, new_path(df.sparkSession, "p1-ledger"))
    ledger.add(summarize(keys.where(~F.col("_late"))))
    ledger.add(summarize(keys.where("_late")))
    return keys, ledger


def delivered_late(days: int = 30) -> Column:
    return F.col("ingested_at") > F.col("created_at") + F.expr(f"INTERVAL {days} DAYS")


def collapsed(df: DataFrame) -> DataFrame:
    """One row per record: ``keep_idx, copies``."""
    return groups(build(df, delivered_late())[1].read()).select("keep_idx", "copies")


def copies(df: DataFrame) -> DataFrame:
    """``keep_idx, copy_idx``: each row that is a copy of an earlier one."""
    keys, ledger = build(df, delivered_late())
    found = classes(keys, ledger.read()).where(F.col("idx") != F.col("first_idx"))
    return found.select(F.col("first_idx").alias("keep_idx"), F.col("idx").alias("copy_idx"))

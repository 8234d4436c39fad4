"""Rows of any shape to canonical records, validation with exact accounting, deduplication, splits and fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.config import DataConfig
from lodestone.functions.text import canonical_text, clean_text, content_hash, strip, text
from lodestone.session import forget, materialize

# Column names under which common data sets keep each canonical field, best first (fixed values).
INSTRUCTION_NAMES = ("instruction", "prompt", "question", "input_text", "query")
CONTEXT_NAMES = ("context", "input", "passage", "document", "source")
RESPONSE_NAMES = ("response", "output", "answer", "completion", "target", "text_output")
CATEGORY_NAMES = ("category", "task", "type", "domain")
BUCKETS = 10_000
SPLITS = ("train", "validation", "test")


def _first(df: DataFrame, names: tuple[str, ...]) -> Column:
    """The first of the columns that holds something; white space counts as something."""
    present = [F.nullif(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*present, F.lit(""))


def normalize(df: DataFrame, source: str, idx: str = "_idx") -> DataFrame:
    """``_idx, id, instruction, context, response, category, meta`` from any table; other columns go to ``meta`` as JSON."""
    known = {*INSTRUCTION_NAMES, *CONTEXT_NAMES, *RESPONSE_NAMES, *CATEGORY_NAMES, "id", idx}
    others = [c for c in df.columns if c not in known]
    ins, res = clean_text(_first(df, INSTRUCTION_NAMES)), clean_text(_first(df, RESPONSE_NAMES))
    number = F.col(idx).cast("string")
    made = F.concat(
        F.substring(F.sha1(F.concat_ws("|", F.lit(source), canonical_text(ins), canonical_text(res))), 1, 12), F.lit("-"), F.lpad(number, F.greatest(F.lit(6), F.length(number)), F.lit("0"))
    )
    given = F.nullif(F.col("id").cast("string"), F.lit("")) if "id" in df.columns else F.lit(None).cast("string")
    meta = F.to_json(F.struct(*[F.col(f"`{c}`") for c in others]), {"ignoreNullFields": "false"}) if others else F.lit("{}")
    return df.select(
        F.col(idx).alias("_idx"),
        F.coalesce(given, made).alias("id"),
        ins.alias("instruction"),
        clean_text(_first(df, CONTEXT_NAMES)).alias("context"),
        res.alias("response"),
        clean_text(_first(df, CATEGORY_NAMES)).alias("category"),
        meta.alias("meta"),
    )


def head(df: DataFrame, n: int | None, idx: str = "_idx") -> DataFrame:
    """The first n rows in source order, as a predicate on the ordinal that reaches the scan."""
    return df if n is None else df.where(F.col(idx) < n)


def failed_rule(c: DataConfig = DataConfig()) -> Column:
    """The first validation rule a record breaks, or null."""
    ins, ctx, res = F.col("instruction"), F.col("context"), F.col("response")
    rules = [
        ("instruction_missing", strip(ins) == ""),
        ("instruction_too_short", F.length(ins) < c.min_instruction_chars),
        ("instruction_too_long", F.length(ins) > c.max_instruction_chars),
        ("response_too_long", F.length(res) > c.max_response_chars),
        ("context_too_long", F.length(ctx) > c.max_context_chars),
        ("response_echoes_instruction", F.lower(strip(ins)) == F.lower(strip(res))),
        ("contains_control_chars", F.concat(ins, F.lit(" "), ctx, F.lit(" "), res).rlike(r"[\x00-\x08\x0b-\x1f]")),
    ]
    if c.drop_empty_response:
        rules += [("response_missing", strip(res) == ""), ("response_too_short", F.length(res) < c.min_response_chars)]
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules], F.lit(None).cast("string"))


def with_hash(records: DataFrame) -> DataFrame:
    return records.withColumn("content_hash", content_hash(F.col("instruction"), F.col("context"), F.col("response")))


def judged(records: DataFrame, c: DataConfig = DataConfig(), keep: tuple[str, ...] | None = None) -> DataFrame:
    """All records with ``content_hash`` and ``reason``: a rule, ``duplicate``, or null for those kept.

    Every record is cleaned, checked and hashed once and written with the columns to ``keep`` (all where not given).
    Duplicates are found on the hashes alone: the first record of each by aggregation with map-side combine, so that a
    record repeated any number of times meets no single task; only the ordinals of the duplicates are joined back, so
    texts move in no shuffle where these are few enough to broadcast. ``_idx`` is unique.
    """
    columns = [x for x in records.columns if x != "_idx" and (keep is None or x in keep)]
    r = with_hash(records.withColumn("failed", failed_rule(c))).select("_idx", *columns, "content_hash", "failed")
    if not c.dedupe:
        return r.withColumnRenamed("failed", "reason")
    r = materialize(r, "judged")
    passed = r.where("failed is null").select("_idx", "content_hash")
    firsts = passed.groupBy("content_hash").agg(F.min("_idx").alias("first_idx"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = passed.join(firsts, "content_hash").where(F.col("_idx") != F.col("first_idx")).select("_idx", F.lit("duplicate").alias("again"))
    return r.join(materialize(again, "duplicates"), "_idx", "left").select("_idx", *columns, "content_hash", F.coalesce("failed", "again").alias("reason"))


def kept(records: DataFrame, c: DataConfig = DataConfig(), keep: tuple[str, ...] | None = None) -> DataFrame:
    return judged(records, c, keep).where("reason is null").drop("reason")


def drop_counts(judged_records: DataFrame) -> DataFrame:
    """``reason, n`` ordered by falling count, first-seen reasons first among equals."""
    g = judged_records.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("_idx").alias("first_idx"))
    return g.orderBy(F.desc("n"), "first_idx").select("reason", "n")


def validation_summary(judged_records: DataFrame, min_keep_rate: float = 0.70) -> DataFrame:
    n, k = F.count(F.lit(1)), F.count_if(F.col("reason").isNull())
    s = judged_records.agg(n.alias("input"), k.alias("kept")).withColumn("dropped", F.col("input") - F.col("kept"))
    rate = F.when(F.col("input") > 0, F.col("kept") / F.col("input")).otherwise(F.lit(0.0))
    return s.select("input", "kept", "dropped", F.round(rate, 6).alias("keep_rate"), ((rate >= min_keep_rate) & (F.col("kept") > 0)).alias("is_healthy"))


def dropped_examples(judged_records: DataFrame, n: int = 20) -> DataFrame:
    """The first n records that broke a rule (duplicates are not shown)."""
    d = judged_records.where("reason is not null and reason <> 'duplicate'").orderBy("_idx").limit(n)
    return d.select("_idx", "id", "reason", F.substring("instruction", 1, 160).alias("instruction"))


def category_counts(records: DataFrame) -> DataFrame:
    return records.groupBy(F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("uncategorized")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_ids(records: DataFrame) -> DataFrame:
    return records.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique_ids(records: DataFrame) -> None:
    bad = [r["id"] for r in duplicate_ids(records).orderBy("id").limit(5).collect()]
    if bad:
        raise ValueError(f"duplicate record ids: {', '.join(bad)}")


def bucket(salt: str, hash_: Column) -> Column:
    first = F.substring(F.sha2(F.concat_ws("|", F.lit(salt), hash_), 256), 1, 8)
    return (F.conv(first, 16, 10).cast("bigint") % BUCKETS).cast("int")


def assign_split(records: DataFrame, c: DataConfig = DataConfig()) -> DataFrame:
    """``bucket`` and ``split`` by content hash, so that growing data never moves a record."""
    a = int(c.train_ratio * BUCKETS)
    b = a + int(c.val_ratio * BUCKETS)
    r = records.withColumn("bucket", bucket(c.salt, F.col("content_hash")))
    return r.withColumn("split", F.when(F.col("bucket") < a, "train").when(F.col("bucket") < b, "validation").otherwise("test"))


def split_sizes(split: DataFrame) -> DataFrame:
    """``split, n``; an empty split shows 0."""
    names = split.sparkSession.createDataFrame([(x,) for x in SPLITS], "split string")
    n = split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return names.join(n, "split", "left").select("split", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def leaked(split: DataFrame) -> DataFrame:
    """Content hashes of the training split that also stand in another (validation against test is not compared)."""
    return split.where("split = 'train'").select("content_hash").distinct().join(split.where("split <> 'train'").select("content_hash"), "content_hash", "left_semi")


def assert_disjoint(split: DataFrame) -> None:
    if not leaked(split).isEmpty():
        raise ValueError("the training split shares records with another split")


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(["".join(b.column(0).to_pylist())])], names=["digits"])


def multiset_hash(hashes: DataFrame) -> tuple[str, int]:
    """SHA-256 over the sorted digests of column ``content_hash``, the same whatever the order of the rows; their number.

    The digest is sequential by definition. The sort is distributed, and the driver consumes it one partition at a
    time, so its memory does not grow with the data. The digests are written once, as finding the range borders and
    sorting read them twice.
    """
    written = materialize(hashes.select("content_hash"), "digests")
    ordered = written.repartitionByRange("content_hash").sortWithinPartitions("content_hash")
    total, n = hashlib.sha256(), 0
    for row in ordered.mapInArrow(_blobs, "digits string").toLocalIterator():
        total.update(row[0].encode("ascii"))
        n += len(row[0]) // 64
    forget(written)
    return total.hexdigest(), n


def fingerprint(records: DataFrame) -> DataFrame:
    """One row: ``content_hash`` of all records and their number."""
    h = records if "content_hash" in records.columns else with_hash(records)
    return records.sparkSession.createDataFrame([multiset_hash(h)], "content_hash string, num_examples bigint")


def split_fingerprints(split: DataFrame) -> DataFrame:
    rows = [(name, *multiset_hash(split.where(F.col("split") == name))) for name in SPLITS]
    return split.sparkSession.createDataFrame(rows, "split string, content_hash string, num_examples bigint")


LIMBS = 16


def limb_sums(hashes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``limbs, num_examples``: the digests added up, in 16 parts of 16 bits.

    A fingerprint of the multiset that needs no order: parts are summed with map-side combine, and the fingerprints of
    two data sets add up to the one of both. Sums of up to 2^47 rows fit.
    """
    limb = [F.sum(F.conv(F.substring("content_hash", 4 * k + 1, 4), 16, 10).cast("bigint")) for k in range(LIMBS)]
    return hashes.groupBy(*by).agg(F.concat_ws(",", *[F.coalesce(x, F.lit(0)).cast("string") for x in limb]).alias("limbs"), F.count(F.lit(1)).alias("num_examples"))


def sum_of_limbs(*limbs: str) -> str:
    """One digest, modulo 2^256, from the ``limbs`` of one or more data sets."""
    total = sum(int(x) << 16 * (LIMBS - 1 - k) for text_ in limbs for k, x in enumerate(text_.split(",")))
    return f"{total % (1 << 256):064x}"


LENGTHS = ("instruction_chars", "response_chars", "total_chars", "has_context")


def with_lengths(records: DataFrame) -> DataFrame:
    i, r = F.length("instruction"), F.length("response")
    return records.withColumns(dict(zip(LENGTHS, (i, r, i + F.length("context") + r, (F.col("context") != "").cast("int")))))


def length_stats(records: DataFrame) -> DataFrame:
    """Means, 95th percentiles by floor rank, maxima, and the share with context; from :data:`LENGTHS` if they are there.

    The four numbers of a record are written once; all ranks come from one histogram of them.
    """
    from lodestone.operators.stats import rank_pick

    i, r, t, c = LENGTHS
    n = materialize((records if set(LENGTHS) <= set(records.columns) else with_lengths(records)).select(*LENGTHS), "lengths")
    base = n.agg(
        F.round(F.avg(i), 2).alias("instruction_chars_mean"), F.round(F.avg(r), 2).alias("response_chars_mean"), F.max(t).cast("double").alias("total_chars_max"), F.round(F.avg(c) * 100, 2).alias("pct_with_context")
    )
    picked = rank_pick(n.unpivot([], [i, r, t], "name", "value"), ["name"], "value", {"p95": 0.95}, "floor")
    one = picked.agg(*[F.coalesce(F.max(F.when(F.col("name") == x, F.col("p95"))), F.lit(0.0)).alias(f"{x}_p95") for x in (i, r, t)])
    return base.crossJoin(F.broadcast(one))


def gold_records(df: DataFrame) -> DataFrame:
    """A gold split read back as records; meta is not carried."""
    return df.select("id", "instruction", text(F.col("context")).alias("context"), "response", text(F.col("category")).alias("category"))


def sampled(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows in a seeded order that no partitioning changes."""
    return df.orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n)


def positions(df: DataFrame, order: list[str], idx: str = "_idx") -> DataFrame:
    """Consecutive ordinals in the given order without a single-task sort: offsets of range partitions are added up."""
    part = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    part = materialize(part, "positions")
    sizes = part.groupBy("_part").count().withColumn("_before", F.sum("count").over(Window.orderBy("_part")) - F.col("count"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return part.withColumn("_within", within).join(F.broadcast(sizes.select("_part", "_before")), "_part").withColumn(idx, F.col("_before") + F.col("_within")).drop("_part", "_within", "_before")

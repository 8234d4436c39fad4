"""Readers and writers of records."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from itertools import groupby
from operator import itemgetter
from pathlib import Path
from typing import Any
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.config import SOURCE_TYPES
from lodestone.operators.records import head, normalize, positions
from lodestone.session import materialize, written_lines

RECORD = "id string, instruction string, context string, response string, category string, meta string"
SUFFIXES = (".jsonl", ".json", ".parquet")
# A scan is narrowed to named files up to this many; beyond, all are scanned. The rows are the same.
MAX_NAMED = 1000


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _is_array(spark: SparkSession, path: str) -> bool:
    # Cut at quotes: a file on one line is not read as one row.
    first = spark.read.text(path, lineSep='"').where(F.trim("value") != "").limit(1).collect()
    return bool(first) and first[0][0].lstrip().startswith("[")


# An array is read in pieces that end with a closing brace: unlike lines they are short in every file of objects, so that
# a file of any size is read by many tasks.
END = "}"
_ESCAPED = re.compile(r"\\.", re.S)
_BLANK = " \t\n\r"


def _no_constant(name: str):
    raise ValueError(f"{name} is not valid JSON")


_JSON = json.JSONDecoder(parse_constant=_no_constant)


def _deeper(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("]")


def _effect(piece: str) -> tuple[int, tuple[int, int]]:
    """Whether strings begin or end an odd number of times, and the brackets it opens if it begins outside or inside of a string."""
    parts = (_ESCAPED.sub("", piece) if "\\" in piece else piece).split('"')
    return (len(parts) - 1) & 1, (_deeper("".join(parts[::2])), _deeper("".join(parts[1::2])))


def _spans(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Per split the effect of all its pieces."""
    of: dict[tuple[str, int], list[int]] = {}
    for b in batches:
        for piece, *split in zip(*(c.to_pylist() for c in b.columns)):
            # Inside at this place if the split began outside; both depths; pieces.
            at = of.setdefault(tuple(split), [0, 0, 0, 0])
            odd, deeper = _effect(piece)
            at[1] += deeper[at[0]]
            at[2] += deeper[1 - at[0]]
            at[0] ^= odd
            at[1 + at[0]] -= 1
            at[3] += 1
    rows = [(*k, *v) for k, v in of.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string() if k == 0 else pa.int64()) for k in range(6)], names=["file", "start", "inside", "outer", "inner", "n"])


class _Cutter:
    """Cuts the pieces of a split behind every object of the array; what is held at the end belongs to the next split."""

    def __init__(self, inside: int, depth: int, held: str = "", first: bool = True):
        self.inside, self.depth, self.held, self.first, self.cuts = inside, depth, [held], first, 0

    def __call__(self, piece: str) -> tuple[str, bool] | None:
        """The text since the cut before and whether the array ends with it, if there is a cut."""
        if self.depth < 0:
            raise ValueError("text after the array")
        odd, deeper = _effect(piece)
        self.depth += deeper[self.inside]
        self.inside ^= odd
        last = not self.inside and not self.depth
        # No brace stands behind the end of the array.
        self.held += [piece] if last else [piece, END]
        self.depth -= not self.inside
        if not last and (self.inside or self.depth != 1):
            return None
        text, self.held = "".join(self.held), []
        self.cuts += 1
        return text, last


def _object(text: str, first: bool, last: bool) -> str | None:
    """The object that ends such a text; the items before it are of other kinds. None behind the last object."""
    text = text.strip(_BLANK)
    if last and not first and text == "]":
        return None
    if text[:1] != ("[" if first else ",") or last and text[-1:] != "]":
        raise ValueError("no item and no comma")
    items = text[1:].lstrip(_BLANK)
    if last:
        if not _JSON.decode("[" + items) and not first:
            raise ValueError("no item after a comma")
        return None
    while True:
        value, end = _JSON.raw_decode(items)
        if end == len(items):
            # Line breaks stand between tokens only.
            return items.replace("\n", " ").replace("\r", " ")
        items = items[end:].lstrip(_BLANK)
        if items[:1] != ",":
            raise ValueError("no comma between items")
        items = items[1:].lstrip(_BLANK)


def _rests(starts):
    """Per split the number of cuts and the text behind the last one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        of: dict[tuple[str, int], _Cutter] = {}
        for b in batches:
            for piece, *split in zip(*(c.to_pylist() for c in b.columns)):
                key = tuple(split)
                if key not in of:
                    of[key] = _Cutter(*starts.value[key])
                of[key](piece)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in of], pa.string()), pa.array([k[1] for k in of], pa.int64()), pa.array([c.cuts for c in of.values()], pa.int64()), pa.array(["".join(c.held) for c in of.values()], pa.string())], names=["file", "start", "cuts", "rest"])

    return run


def _objects(starts):
    """The objects of the array, one text each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        key = cut = None
        for b in batches:
            out = []
            for piece, *split in zip(*(c.to_pylist() for c in b.columns)):
                if split != key:
                    key, cut = split, _Cutter(*starts.value[tuple(split)])
                try:
                    if (found := cut(piece)) is not None:
                        text, last = found
                        out.append(_object(text, cut.first, last))
                        cut.first = False
                except ValueError as e:
                    raise ValueError(f"{unquote(key[0])} is not valid JSON: {e}") from e
            yield pa.RecordBatch.from_arrays([pa.array([x for x in out if x is not None], pa.string())], names=["value"])

    return run


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """The objects of a JSON array, in its order as source order; items of other kinds are left out. A file that does not parse raises.

    No task and no row holds the file: whether a split begins inside of a string, and how deep, follows from the effects of
    the splits before it, and an object that spans splits is read where it ends. Of every split only numbers and the text of
    one unfinished object reach the driver.
    """
    pieces = spark.read.text(path, lineSep=END).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    spans = sorted(map(tuple, pieces.mapInArrow(_spans, "file string, start bigint, inside bigint, outer bigint, inner bigint, n bigint").collect()))
    # A brace that ends the file is lost in the pieces; those between opening braces hold it.
    braces = spark.read.text(path, lineSep="{").select(F.col("_metadata.file_path").alias("file"), (F.length("value") - F.length(F.replace("value", F.lit(END)))).alias("n"))
    closing = dict(map(tuple, braces.groupBy("file").agg(F.sum("n")).collect()))
    starts: dict[tuple[str, int], tuple] = {}
    for file, splits in groupby(spans, itemgetter(0)):
        inside = depth = n = 0
        for k, (_, start, odd, outer, inner, pieces_) in enumerate(splits):
            if k and depth < 1:
                raise ValueError(f"{unquote(file)} is not valid JSON")
            starts[file, start] = (inside, depth)
            depth += inner if inside else outer
            inside ^= odd
            n += pieces_
        if inside or depth != -1 or closing[file] != n - 1:
            raise ValueError(f"{unquote(file)} is not valid JSON")
    if len(starts) > len(closing):
        rests = sorted(map(tuple, pieces.mapInArrow(_rests(spark.sparkContext.broadcast(starts)), "file string, start bigint, cuts bigint, rest string").collect()))
        for file, splits in groupby(rests, itemgetter(0)):
            held, first = "", True
            for _, start, cuts, rest in splits:
                starts[file, start] += (held, first)
                held, first = rest if cuts else held + rest, first and not cuts
    items = pieces.mapInArrow(_objects(spark.sparkContext.broadcast(starts)), "value string")
    # Written as lines, so that the columns are found by the reader of lines and later stages read in parallel.
    return spark.read.json(written_lines(items))


def read_json_file(spark: SparkSession, path: str) -> DataFrame:
    """An array if the file begins with a bracket, else lines, whatever the suffix says."""
    return read_json_array(spark, path) if _is_array(spark, path) else read_jsonl_strict(spark, path)


def read_data_file(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return read_jsonl_strict(spark, path) if path.endswith(".jsonl") else read_json_file(spark, path)


def _no_object(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """The files of lines that are no JSON object; the engine's own parser accepts some cut-off objects."""
    for b in batches:
        bad = set()
        for line, file in zip(*(c.to_pylist() for c in b.columns)):
            if not _is_object(line):
                bad.add(file)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(bad), pa.string())], names=["file"])


def _is_object(line: str) -> bool:
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


def read_jsonl_strict(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; blank lines are skipped, a bad line raises with its file and number (the first of the first such file)."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    bad = lines.mapInArrow(_no_object, "file string").agg(F.min("file")).first()[0]
    if bad is not None:
        numbered = in_source_order(spark.read.text(bad), "_line").where(F.trim("value") != "").orderBy("_line")
        for value, n in numbered.toLocalIterator():
            if not _is_object(value):
                raise ValueError(f"{unquote(bad)}:{n + 1} is not valid JSON")
    return spark.read.json(path)


def read_records_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Canonical records read back under their schema; anything else fails."""
    return spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)


def read_hub_files(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """Data files of a downloaded repository, in order of their names; those whose stem names the split, if any do."""
    files = sorted(str(p) for p in Path(folder).rglob("*") if p.suffix in SUFFIXES)
    if not files:
        raise FileNotFoundError(f"no data files in {folder}")
    chosen = [f for f in files if split in Path(f).stem.lower()] or files
    parts = [in_source_order(read_data_file(spark, f), "_row").withColumn("_file", F.lit(k)) for k, f in enumerate(chosen)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _split_place(raw: DataFrame) -> list[Column] | None:
    """What names the split of the source that a row comes from, if the rows come from files."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    try:
        raw.select(*place)
    except AnalysisException:
        return None
    return place


def in_source_order(raw: DataFrame, idx: str = "_idx", head: int | None = None) -> DataFrame:
    """The rows with their ordinal in source order: by file name, place in the file, row. Of these the first ``head``.

    No row is sorted. A task reads the rows of a split in order, so a number that grows within the task tells their
    places; only the table of splits, one row each, is ordered, and its running count gives every split its offset.
    With ``head``, files behind the last one needed are not read for their rows. Rows that come from no file keep the
    order of their partitions.
    """
    place = _split_place(raw)
    if head is not None and place:
        sizes = raw.select(place[0].alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("file")) - F.col("n")).where(F.col("before") < head)
        needed = [r.file for r in before.select("file").limit(MAX_NAMED + 1).collect()]
        if len(needed) <= MAX_NAMED:
            raw = raw.where(place[0].isin(needed))
    file, start = place or (F.lit(""), F.spark_partition_id())
    rows = materialize(raw.select("*", file.alias("_file_name"), start.cast("bigint").alias("_start"), F.monotonically_increasing_id().alias("_at")), "in-order")
    splits = rows.groupBy("_file_name", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    offsets = splits.withColumn("_offset", F.sum("_n").over(Window.orderBy("_file_name", "_start")) - F.col("_n") - F.col("_first")).drop("_n", "_first")
    out = rows.join(offsets, ["_file_name", "_start"]).withColumn(idx, F.col("_at") + F.col("_offset")).select(*raw.columns, idx)
    return out if head is None else out.where(F.col(idx) < head)


def shuffled(raw: DataFrame, seed: int, head: int | None = None, order: tuple[str, ...] = ("_file", "_row"), idx: str = "_idx") -> DataFrame:
    """The rows in a seeded order that no partitioning changes, with their ordinal in it; of these the first ``head``."""
    key = F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in order]), 256)
    drawn = raw.withColumn("_key", key)
    if head is not None:
        drawn = drawn.orderBy("_key", *order).limit(head)
    return positions(drawn, ["_key", *order], idx).drop("_key", *order)


def load_records(spark: SparkSession, source: str, kind: str, max_examples: int | None = None, idx: str | None = None, split: str = "train", seed: int = 42) -> DataFrame:
    """Dispatch on the kind of source, limit before cleaning, normalise with the row's ordinal.

    The ordinal is column ``idx`` where it is named; else the place in the source, and for folders of downloaded files
    the place after a seeded shuffle.
    """
    kind = SOURCE_TYPES.get(kind, kind)
    if kind == "hub":
        return normalize(shuffled(read_hub_files(spark, source, split), seed, max_examples), source)
    if kind == "table":
        raw = spark.read.table(source)
    elif kind == "jsonl":
        raw = read_jsonl_strict(spark, source)
    elif kind == "parquet":
        raw = spark.read.parquet(source)
    else:
        raise ValueError(f"unknown source type {kind!r}")
    if idx is None:
        return normalize(in_source_order(raw, "_idx", max_examples), source)
    return normalize(head(raw, max_examples, idx), source, idx)


def write_jsonl(records: DataFrame, path: str, single_file: bool = False) -> str:
    """One object a line, meta as an object. ``single_file`` is for small results only."""
    out = records.withColumn("meta", F.coalesce(F.try_parse_json("meta"), F.parse_json(F.lit("{}"))))
    (out.coalesce(1) if single_file else out).write.mode("overwrite").json(path)
    return path


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def folder_mb(spark: SparkSession, path: str) -> float:
    """Total size of the files below a folder, from their listing."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() / 1048576 if fs.exists(p) else 0.0


def write_json_report(report: Any, path: str | Path) -> Path:
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(report, indent=2, ensure_ascii=False, default=str), encoding="utf-8")
    return target


def read_json_report(path: str | Path) -> Any:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def markdown_table(columns: Iterable[str], rows: Iterable[Iterable[Any]]) -> str:
    head_ = list(columns)
    lines = ["| " + " | ".join(head_) + " |", "|" + "|".join("---" for _ in head_) + "|"]
    return "\n".join(lines + ["| " + " | ".join(str(x) for x in r) + " |" for r in rows])

"""Splits that keep related records together (problem 3).

Records are related if their contexts give the same passage, credit the same author or the same work, or if their
categories carry the same entity label; chains count. Each of these is a hub; a row that has several hubs joins them,
and the connected components of the hubs give the groups. Hubs, not rows, are the vertices, so a passage shared by a
third of all rows is one vertex.

Passages: credit lines are taken off, equal letters and digits are one passage. Reworded passages agree in word bigrams
at 0.8 or more (Dice); TESTDATA asks for "small wording changes", and one word changed takes two bigrams. They are found
in two passes. The first is cheap: every distinct passage keeps its 32 least hashes of five-word shingles and is compared,
for each of them, with the first passage that has the same one. It only joins what it verifies; nothing is spent by it.
The second is exact: two such passages share more than a third of the lesser's bigrams whatever the order, so among the
rarest third of either (and one more) at least one is common to both. Passages that meet there, are of fitting sizes, not
joined by the first pass and not ruled out by the parity bits of their bigrams are verified too.

Authors: "Author: A B", "By A B", "(written by A B)", "Text (c) A B", a line of dash and name, "[B, A]" and "B, A:".
The dash, bracket and comma forms and a bare "By" also occur in prose; they count only if the given name is credited
elsewhere in an unmistakable form. Works: "Source: T, no. n", "First printed in T, p. n", '(from T)', 'Excerpt from "T".', "T |".

Splits: largest differencing. Components become atoms (the large ones alone, the small ones by hash slice, so that
their number is bounded); the two partitions of widest spread are combined, largest bin with smallest, until one
partition of many nearly equal bins is left, and whole bins go to the split that lacks most.

Defined cases: rows of ``split_targets`` without a name are ignored, those of one name are added up, and more than 1,000
names are an error; null, empty and blank contexts and passages under four words relate to nothing; so do null categories;
repeated rows are related to each other if they have a hub; rows without hubs are groups of one; empty tables give
empty results.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.categories import entity_key
from lodestone.llm.components import components
from lodestone.session import materialize

SHINGLE, SKETCH, AGREE, SIMILAR, LEAST_WORDS = 5, 32, 3, 0.8, 4
SLICES, BINS = 1024, 120
# Hash buckets in which bigrams are counted: this changes how long the lists get, not what is found.
BUCKETS = 1 << 16
MAX_TARGETS = 1000

_W = re.compile(r"[^\W_]+")
_N = r"([^\W\d_]{2,})"
_END = r"[\s\"'”’»)\]*_.!]*$"
_TITLE = r"((?:[^\W_]+[ \-]){1,6}[^\W_]+)"
_I = re.IGNORECASE
# (pattern, kind, certain). Authors have two groups, works one; "swapped" has the surname first.
_TAILS = [
    (re.compile(rf"[(\[]\s*written by\s+{_N}[\s\-]+{_N}\s*[)\]]?{_END}", _I), "author", True),
    (re.compile(rf"\btext\s*(?:©|\(c\))\s*{_N}[\s\-]+{_N}{_END}", _I), "author", True),
    (re.compile(rf"(?:^|[\n.!?…\"”»’)])\s*(?:—|–|--?)\s*{_N}[\s\-]+{_N}{_END}", _I), "author", False),
    (re.compile(rf"\bfirst printed in\s+{_TITLE}\W+p\W*\d+{_END}", _I), "work", True),
    (re.compile(rf"[(\[]\s*from\s+{_TITLE}\s*[)\]]?{_END}", _I), "work", True),
]
_HEADS = [
    (re.compile(rf"^\W*author\s*:\s*{_N}[\s\-]+{_N}[)\]\"'”’*_.]*\s+", _I), "author", True),
    (re.compile(rf"^\W*source\s*:\s*{_TITLE}\W+no\W*\d+[)\]\"'”’*_.]*\s+", _I), "work", True),
    (re.compile(rf"^\W*excerpt from\s+[\"'“”«„*_]*{_TITLE}[\"'“”»’*_]*\s*[.!\n\"“”»]\W*", _I), "work", True),
    (re.compile(rf"^[\s\"'“«(*_]*{_TITLE}[*_]*\s*\|\s*", _I), "work", True),
    (re.compile(rf"^[\s\"'“«(*_]*\[\s*{_N}\W+{_N}\s*\]\s*"), "swapped", False),
    (re.compile(rf"^[\s\"'“«(*_]*{_N}\s*,\s*{_N}\s*:\s*"), "swapped", False),
    (re.compile(rf"^[\s\"'“«(*_]*by\s+{_N}[\s\-]+{_N}[)\]\"'”’*_.]*\s+", _I), "author", False),
]


def _key(*parts: str) -> str:
    return "".join(c for p in parts for c in p.upper() if c.isalnum())


def credits(context: str) -> tuple[str, list[tuple[str, str, str | None]]]:
    """The passage without its credits, and the credits: ('A', key, None), ('a', key, given name) or ('W', key, None)."""
    text = re.sub(r"[^\S\n]+", " ", context.replace("\r\n", "\n").replace("\r", "\n")).strip(" \n​﻿⁠")
    found: list[tuple[str, str, str | None]] = []
    for patterns, head in ((_TAILS, False), (_HEADS, True)):
        again = True
        while again:
            again = False
            for p, kind, certain in patterns:
                if not (m := p.search(text) if not head else p.match(text)):
                    continue
                if kind == "work":
                    found.append(("W", _key(m[1]), None))
                else:
                    given, sur = (m[2], m[1]) if kind == "swapped" else (m[1], m[2])
                    # Forms that prose can have ('a') count only if their given name is credited elsewhere.
                    found.append(("A" if certain else "a", _key(given) + "|" + _key(sur), _key(given)))
                text = text[m.end() :] if head else text[: m.start() + (1 if m[0][:1] in ".!?…\"”»’)" else 0)]
                again = bool(text)
                break
    return text, found


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (idx, context) to (idx, kind, key, given, body): one row per credit and one for the passage."""
    names = ["idx", "kind", "key", "given", "body"]
    for b in batches:
        cols: tuple[list, ...] = ([], [], [], [], [])
        for idx, context in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            body, found = credits(context)
            for kind, key, given in found:
                for c, x in zip(cols, (idx, kind, key, given, None)):
                    c.append(x)
            words = _W.findall(body.lower())
            if len(words) >= LEAST_WORDS:
                letters = "".join(words)
                for c, x in zip(cols, (idx, "P", xxhash.xxh3_128_hexdigest(letters.encode()), None, " ".join(words))):
                    c.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])], names=names)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, marks, sizes = [], [], []
        for key, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            w = body.split(" ")
            least = sorted({xxhash.xxh3_64_intdigest(" ".join(w[i : i + SHINGLE])) - (1 << 63) for i in range(max(1, len(w) - SHINGLE + 1))})[:SKETCH]
            keys += [key] * len(least)
            marks += least
            sizes += [len(least)] * len(least)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(marks, pa.int64()), pa.array(sizes, pa.int32())], names=["pid", "mark", "size"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            p, q = x.split(" "), y.split(" ")
            a, c = Counter(zip(p, p[1:])), Counter(zip(q, q[1:]))
            keep.append(2 * (a & c).total() >= SIMILAR * (a.total() + c.total()))
        yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _bigrams(body: str) -> list[int]:
    """A hash for every word bigram; repeated ones count as different."""
    w, out, n = body.split(" "), [], Counter()
    for x in zip(w, w[1:]):
        out.append(xxhash.xxh3_64_intdigest(f"{x[0]} {x[1]} {n[x]}"))
        n[x] += 1
    return out


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, dtype="int64")
    for b in batches:
        n += np.bincount([g & (BUCKETS - 1) for body in b.column(0).to_pylist() for g in _bigrams(body)], minlength=BUCKETS)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used])], names=["bucket", "n"])


def _prefixes(often: list[int]):
    """Rows (pid, root, body) to one row for each of the passage's rarest bigrams, with size and 256 parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pid", "root", "gram", "size", "b0", "b1", "b2", "b3"]
        for b in batches:
            cols: tuple[list, ...] = tuple([] for _ in names)
            for pid, root, body in zip(*(c.to_pylist() for c in b.columns)):
                grams, bits = _bigrams(body), 0
                for g in grams:
                    bits ^= 1 << (g >> 56)
                n = len(grams)
                # 2 * common >= 0.8 * (n + m) and common <= m: at least 2/3 of n are common.
                first = sorted(grams, key=lambda g: (often[g & (BUCKETS - 1)], g))[: n - -(-2 * n // 3) + 1]
                cols[2].extend(g - (1 << 63) for g in first)
                for k, v in zip((0, 1, 3, 4, 5, 6, 7), (pid, root, n, *((bits >> 64 * i & (1 << 64) - 1) - (1 << 63) for i in range(4)))):
                    cols[k].extend([v] * len(first))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if x == "size" else pa.int64()) for x, c in zip(names, cols)], names=names)

    return run


def verified(bodies: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of ``near`` (pid, first) whose bigrams agree."""
    text = bodies.select(F.col("pid").alias("first"), F.col("body").alias("other"))
    return near.join(bodies.select("pid", "body"), "pid").join(text, "first").select("pid", "first", "body", "other").mapInArrow(_alike, "a bigint, b bigint")


def missed(bodies: DataFrame, links: DataFrame) -> DataFrame:
    """``a, b``: all pairs of passages of the same wording that ``links`` do not join yet."""
    rows = bodies.select("body").mapInArrow(_seen, "bucket int, n bigint")
    # A table of fixed size.
    n = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    often = np.zeros(BUCKETS, dtype="int64")
    often[n["bucket"]] = n["n"]
    joined = components(links).select(F.col("v").alias("pid"), "root")
    rooted = bodies.join(joined, "pid", "left").select("pid", F.coalesce("root", "pid").alias("root"), "body")
    lists = materialize(rooted.mapInArrow(_prefixes(often.tolist()), "pid bigint, root bigint, gram bigint, size int, b0 bigint, b1 bigint, b2 bigint, b3 bigint"), "p3-lists")
    x, y = (lists.select("gram", *[F.col(c).alias(f"{c}_{k}") for c in lists.columns if c != "gram"]) for k in "xy")
    # Every bigram that only one of the two has flips one bit; at most a fifth of both sizes may.
    flipped = sum((F.bit_count(F.col(f"b{i}_x").bitwiseXOR(F.col(f"b{i}_y"))) for i in range(4)), F.lit(0))
    close = 5 * flipped <= F.col("size_x") + F.col("size_y")
    met = x.join(y, "gram").where((F.col("pid_x") > F.col("pid_y")) & (F.col("root_x") != F.col("root_y")) & close)
    return verified(bodies, met.select(F.col("pid_x").alias("pid"), F.col("pid_y").alias("first")).distinct())


def similar_passages(bodies: DataFrame) -> DataFrame:
    """``a, b``: passages (pid, body) to an earlier passage of the same wording but for small changes."""
    marks = materialize(bodies.select("pid", "body").mapInArrow(_sketch, "pid bigint, mark bigint, size int"), "p3-sketch")
    first = marks.groupBy("mark").agg(F.min("pid").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("mark", "first")
    near = marks.join(first, "mark").where("pid <> first").groupBy("pid", "first").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    near = near.where((F.col("n") >= AGREE) | (F.col("size") <= 2 * AGREE)).select("pid", "first")
    links = materialize(verified(bodies, near), "p3-first")
    return links.unionByName(missed(bodies, links))


def hubs(df: DataFrame) -> DataFrame:
    """``idx, hub`` for every hub of every row."""
    rows = df.select(F.col("_idx").cast("bigint").alias("idx"), "context").where(F.col("context").rlike(r"\w"))
    read = materialize(rows.mapInArrow(_read, "idx bigint, kind string, key string, given string, body string"), "p3-read")
    # Short numbers for the distinct passages; they stay the same as they are written once.
    bodies = read.where("kind = 'P'").groupBy("key").agg(F.min("body").alias("body")).withColumn("pid", F.monotonically_increasing_id())
    bodies = materialize(bodies, "p3-bodies")
    same = components(similar_passages(bodies)).select(F.col("v").alias("pid"), "root")
    known = bodies.select("key", "pid").join(same, "pid", "left").select("key", F.concat(F.lit("P:"), F.coalesce("root", "pid").cast("string")).alias("hub"))
    passages = read.where("kind = 'P'").select("idx", "key").join(known, "key").select("idx", "hub")
    givens = read.where("kind = 'A'").select("given").distinct()
    sure = read.where("kind = 'A'").select("idx", F.concat(F.lit("A:"), "key").alias("hub"))
    maybe = read.where("kind = 'a'").join(givens, "given", "left_semi").select("idx", F.concat(F.lit("A:"), "key").alias("hub"))
    works = read.where("kind = 'W'").select("idx", F.concat(F.lit("W:"), "key").alias("hub"))
    labels = df.select(F.col("_idx").cast("bigint").alias("idx"), F.concat(F.lit("E:"), entity_key(F.col("category"))).alias("hub")).where("hub is not null")
    return materialize(passages.unionByName(sure).unionByName(maybe).unionByName(works).unionByName(labels), "p3-hubs")


def grouped(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with hubs as ``idx, root`` and the groups as ``root, group_idx, size``."""
    h = hubs(df)
    ends = h.groupBy("idx").agg(F.min("hub").alias("low"))
    edges = h.join(ends, "idx").select(F.col("low").alias("a"), F.col("hub").alias("b")).distinct()
    roots = components(edges)
    rows = materialize(ends.join(roots, ends["low"] == roots["v"]).select("idx", "root"), "p3-rows")
    return rows, rows.groupBy("root").agg(F.min("idx").alias("group_idx"), F.count(F.lit(1)).alias("size"))


def related(df: DataFrame) -> DataFrame:
    """``group_idx, rec_idx``: each row related to an earlier one."""
    rows, groups = grouped(df)
    return rows.join(groups.where("size > 1"), "root").where("idx <> group_idx").select("group_idx", F.col("idx").alias("rec_idx"))


def difference(weights: dict[str, int], bins: int) -> list[tuple[int, list[str]]]:
    """Largest differencing over ``bins`` bins: (weight, atoms) of each, nearly equal."""
    if not weights:
        return [(0, []) for _ in range(bins)]
    heap = []
    for k, (name, w) in enumerate(sorted(weights.items(), key=lambda x: (-x[1], x[0]))):
        heap.append((-w, k, [(w, [name])]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, k, x = heapq.heappop(heap)
        _, _, y = heapq.heappop(heap)
        # Bins a partition does not list are empty: the largest of one meet the smallest of the other.
        x = sorted(x, key=lambda b: -b[0]) + [(0, [])] * (bins - len(x))
        y = [(0, [])] * (bins - len(y)) + sorted(y, key=lambda b: b[0])
        z = [(a + b, p + q) for (a, p), (b, q) in zip(x, y)]
        z = [b for b in z if b[1]]
        spread = max(b[0] for b in z) - (min(b[0] for b in z) if len(z) == bins else 0)
        heapq.heappush(heap, (-spread, k, z))
    z = heap[0][2]
    return z + [(0, [])] * (bins - len(z))


def splits(df: DataFrame, targets: DataFrame) -> DataFrame:
    """``rec_idx, split_name`` for every row; related rows share one split, shares follow ``targets``."""
    spark = df.sparkSession
    rows, groups = grouped(df)
    total = df.count()
    large = max(1, total // (16 * SLICES))
    atom = F.when(F.col("size") > large, F.concat(F.lit("g"), F.col("group_idx").cast("string"))).otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("group_idx"), F.lit(SLICES)).cast("string")))
    sized = rows.join(groups, "root").select("idx", atom.alias("atom"))
    alone = F.concat(F.lit("s"), F.pmod(F.xxhash64("idx"), F.lit(SLICES)).cast("string"))
    everyone = df.select(F.col("_idx").cast("bigint").alias("idx")).join(sized.distinct(), "idx", "left").select("idx", F.coalesce("atom", alone).alias("atom"))
    everyone = materialize(everyone, "p3-atoms")
    # At most 16 * SLICES large atoms and SLICES slices.
    weights = {a: n for a, n in everyone.groupBy("atom").count().toPandas().itertuples(index=False, name=None)}
    goal = targets.where("split_name is not null").groupBy("split_name").agg(F.sum(F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)))).limit(MAX_TARGETS + 1).collect()
    if len(goal) > MAX_TARGETS:
        raise ValueError("too many splits")
    lack = {name: share * total for name, share in goal}
    place = []
    for w, atoms in sorted(difference(weights, BINS), key=lambda b: -b[0]):
        if atoms and lack:
            name = max(lack, key=lambda s: (lack[s], s))
            lack[name] -= w
            place += [(a, name) for a in atoms]
    placed = spark.createDataFrame(pd.DataFrame(place, columns=["atom", "split_name"]), "atom string, split_name string")
    return everyone.join(F.broadcast(placed), "atom").select(F.col("idx").alias("rec_idx"), "split_name")


def split_shares(df: DataFrame, targets: DataFrame) -> DataFrame:
    n = splits(df, targets).groupBy("split_name").agg(F.count(F.lit(1)).alias("rows"))
    r = targets.select("split_name", "target_share").join(n, "split_name", "left").na.fill(0, ["rows"])
    return r.crossJoin(F.broadcast(r.agg(F.sum("rows").alias("all_rows")))).select(
        "split_name", "target_share", "rows", F.when(F.col("all_rows") > 0, F.round(F.col("rows") / F.col("all_rows"), 6)).alias("share")
    )

"""Records of the evaluation splits that also stand in the training split, exactly or almost (problem 6).

Method: a weighted cosine join over inverted lists. Records whose three fields agree apart from formatting form a class
(the groups of the ledger operator). A class is a vector of term weights for each field: its words, the rare ones heavy,
by counts over all records. The definition lets at most :func:`allowed` words of a field of n words differ, so whatever
these are, the dot product of two matching fields is at least the *floor*: the squared norm less the heaviest
``allowed`` words. Two bounds keep lists and pairs short and lose none above the floor:

* maximum weight: words are taken by falling weight until what is left could not reach the floor even if all of it
  matched. These are the first ``allowed + 1`` words; the others stand in no list. Of a class without evaluation rows
  words that no evaluation record has are left out too.
* residual norm: where two classes meet in a list through their first common word, the words before it match nothing, so
  their dot product is at most the product of the norms of what follows. Meetings for which this is below the floor of
  either are dropped.

Short lists come from terms of two words, one of the instruction and one of the response (the dot product of the two
fields' outer product is the product of their dot products, and the bounds hold for each factor). Where a class would have
too many, it is listed under the first words of all three fields taken together; between the two limits it is listed
both ways, as two matching records are not always of one size. Long lists that fall on one key are split by adaptive
execution.

Pairs met in the lists are held against the parity bits of their words (which differ in no more places than words do)
and their word counts. For what is left the exact dot product and cosine are computed on the texts, and the definition
decides, field by field. The result is pairs of classes and the class of every record; a query may expand these to
pairs of records.

Defined cases: null equals empty; three empty fields make a class like any other; equal rows all pair up; the same
record several times on either side gives one row per pair of rows; a transposed pair of letters is no change; the classes whose
instruction and response have no words share the lists of empty fields; empty
tables give no pairs; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.ledger import keyed
from lodestone.session import forget, materialize

# Records of up to NARROW pairs of first words are listed under these only, of more than WIDE under single words only.
# A field's number of first words is at most twice that of a matching field, so matching records share one of the ways.
NARROW, WIDE = 64, 256
# Hash buckets in which words are counted: how heavy a word is changes how long the lists get, not what is found.
BUCKETS = 1 << 16
FIELDS = ("instruction", "context", "response")

_W = re.compile(r"[^\W_]+")
_SPACED = {k: " " for k in range(128) if not chr(k).isalnum()}


def words(text: str | None) -> list[str]:
    """Lower-case words. Only which and how many there are counts, so a moved line or pair is no change."""
    if not text:
        return []
    low = text.lower()
    # The same words, found faster where every letter is ASCII.
    return low.translate(_SPACED).split() if low.isascii() else _W.findall(low)


_M = (1 << 64) - 1
_TAG, _AGAIN = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15
# Words whose hashes are kept between records; the store is emptied when full, which changes no result.
HELD = 200_000


def hashes(text: str | None, memo: dict[str, int]) -> list[int]:
    """A hash for every word of the field; words that count as equal share it."""
    ws = words(text)
    out = list(map(memo.get, ws))
    if None in out:
        if len(memo) > HELD:
            memo.clear()
        for w in ws:
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(_bag_key(w))
        out = [memo[w] for w in ws]
    return out


def _repeats(hs: list[int], tag: int) -> list[int]:
    """Terms for the second and later ones of equal words."""
    once: set[int] = set()
    add, off, n, out = once.add, tag * _TAG, {}, []
    for h in [h for h in hs if h in once or add(h)]:
        k = n[h] = n.get(h, 0) + 1
        out.append((h + off + k * _AGAIN) & _M)
    return out


def tokens(hs: list[int], tag: int) -> list[int]:
    """Terms of field number ``tag`` from its :func:`hashes`: the second of equal words is a term of its own."""
    off = tag * _TAG
    return [(h + off) & _M for h in set(hs)] + _repeats(hs, tag)


def _bucket(token: int) -> int:
    return (token * 0xFF51AFD7ED558CCD & _M) >> 48


def _buckets(t: np.ndarray) -> np.ndarray:
    return (t * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(48)).astype("int64")


def _mix(h: np.ndarray | np.uint64, part: np.ndarray) -> np.ndarray:
    h = (h ^ part) * np.uint64(0xC4CEB9FE1A85EC53) + np.uint64(1)
    return h ^ h >> np.uint64(29)


def _log(x: np.ndarray, up: bool) -> np.ndarray:
    """The logarithm of a norm in steps of 1/8, in one byte, rounded so that bounds stay bounds."""
    v = np.log2(np.maximum(x, 0.0078125)) * 8 + 64
    return np.minimum(np.ceil(v) if up else np.floor(v), 255).astype("int64")


# Stands behind the words of a text where those of many texts are found at once.
_MARK = "\x01"
_MARKED = _SPACED | {ord(_MARK): _MARK}
_WM = re.compile(rf"[^\W_]+|{_MARK}")


class _Numbers(dict):
    """A number for every word, and a hash for every number; words that count as equal share it."""

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self[_MARK] = -1
        self.of: dict[str, int] = {}
        self.new: list[int] = []
        self.hash = np.zeros(0, dtype="uint64")

    def __missing__(self, w: str) -> int:
        key = _bag_key(w)
        n = self.of.get(key)
        if n is None:
            n = self.of[key] = len(self.of)
            self.new.append(xxhash.xxh3_64_intdigest(key))
        self[w] = n
        return n

    def hashes(self) -> np.ndarray:
        if self.new:
            self.hash, self.new = np.concatenate([self.hash, np.array(self.new, dtype="uint64")]), []
        return self.hash


def _numbered(texts: list[str], numbers: _Numbers) -> tuple[np.ndarray, np.ndarray]:
    """For every word of the texts the place of its text, and its number."""
    places, found = [], []
    plain = [x.isascii() for x in texts]
    for ascii_ in (True, False):
        mine = [k for k, x in enumerate(plain) if x is ascii_]
        if not mine:
            continue
        parts = [texts[k] for k in mine]
        # Words do not reach over the spaces, nor does the form of a final sigma.
        joined = f" {_MARK} ".join([*parts, ""])
        if joined.count(_MARK) != len(parts):
            joined = f" {_MARK} ".join([*(x.replace(_MARK, " ") for x in parts), ""])
        low = joined.lower()
        ws = low.translate(_MARKED).split() if ascii_ else _WM.findall(low)
        n = np.fromiter(map(numbers.__getitem__, ws), "int64", len(ws))
        ends = np.flatnonzero(n < 0)
        places.append(np.repeat(np.array(mine, dtype="int64"), np.diff(ends, prepend=-1) - 1))
        found.append(n[n >= 0])
    return np.concatenate(places), np.concatenate(found)


# Bytes of text whose words are handled at once.
CHUNK = 4_000_000


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        step = max(1, b.num_rows * CHUNK // max(b.nbytes, CHUNK))
        for k in range(0, b.num_rows, step):
            yield b.slice(k, step)


def _terms(columns: list[pa.Array], numbers: _Numbers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every word its place (row times fields plus field), in order, its hash, and its term as :func:`tokens` gives it."""
    if len(numbers) > HELD:
        numbers.forget()
    found = [_numbered([x or "" for x in c.to_pylist()], numbers) for c in columns]
    key = np.concatenate([(at * len(FIELDS) + k) << 32 | n for k, (at, n) in enumerate(found)])
    key.sort()
    begins = np.flatnonzero(np.diff(key, prepend=-1))
    again = np.arange(len(key)) - np.repeat(begins, np.diff(begins, append=len(key)))
    place, h = key >> 32, numbers.hashes()[key & 0xFFFFFFFF]
    return place, h, h + (place % len(FIELDS)).astype("uint64") * np.uint64(_TAG) + again.astype("uint64") * np.uint64(_AGAIN)


class Terms:
    """What is known of terms: their weights, and whether evaluation records may have them."""

    def __init__(self, weight: list[float], seen: list[int]):
        self.weight, self.seen = np.array(weight), np.array(seen, dtype="uint64")
        # Equal weights have equal ranks, the heaviest the first.
        self.rank = np.unique(-self.weight, return_inverse=True)[1].astype("int64")

    def of(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at = _buckets(t)
        return t, self.weight[at], self.rank[at], self.seen[at] >> (t >> np.uint64(10) & np.uint64(63)) & np.uint64(1) > 0

    def __call__(self, hs: list[int], tag: int) -> tuple[np.ndarray, ...]:
        """The terms of one field with their weights, ranks and whether evaluation records may have them."""
        return self.of(np.array(tokens(hs, tag), dtype="uint64"))


def _may(n: np.ndarray) -> np.ndarray:
    """:func:`allowed`"""
    return np.where(n < 4, 0, np.where(n < 8, 1, np.maximum(2, (0.15 * n).astype("int64"))))


class _Firsts:
    """The terms of texts by falling weight, those that make list entries, and their bounds."""

    def __init__(self, place: np.ndarray, weighted: tuple[np.ndarray, ...], n: np.ndarray, may: np.ndarray):
        # Texts without words stand in the list of no term.
        none = np.flatnonzero(n == 0)
        fill = (none, *(np.full(len(none), x, dtype=c.dtype) for x, c in zip((0, 1.0, 0, True), weighted)))
        place, t, w, rank, seen = (np.concatenate(x) for x in zip((place, *weighted), fill))
        # Equal weights are ordered by term, the same way on both sides.
        order = np.lexsort((t, place << 17 | rank))
        place, w = place[order], w[order]
        n = np.maximum(n, 1)
        begin = np.cumsum(n) - n
        before = np.cumsum(w) - w
        left = (before[begin] + np.add.reduceat(w, begin))[place] - before
        first = np.flatnonzero(np.arange(len(place)) - begin[place] <= may[place])
        self.place, self.term, self.seen = place[first], t[order][first], seen[order][first]
        self.floor, self.rest = _log(left[begin + may], False), _log(left[first], True)
        self.n = may + 1

    def entries(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the kept terms their text, themselves and their norms in two bytes."""
        at = np.flatnonzero(keep)
        return self.place[at], self.term[at], self.rest[at] | self.floor[self.place[at]] << 8


def _lists(place: np.ndarray, weighted: tuple[np.ndarray, ...], train_only: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """List entries of records: the record, the list, and the norms of its two factors in bytes; and how many words may differ."""
    rows, width = len(train_only), len(FIELDS)
    n = np.bincount(place, minlength=rows * width)
    may = _may(n)
    firsts = _Firsts(place, weighted, n, may)
    row, field = firsts.place // width, firsts.place % width
    ways = firsts.n[0::width] * firsts.n[2::width]
    kept = (~train_only[row] | firsts.seen) & (ways <= WIDE)[row]
    (p, pt, pn), (q, qt, qn) = (firsts.entries(kept & (field == k)) for k in (0, 2))
    p, q = p // width, q // width
    # Every first word of the instruction with every one of the answer.
    times = np.bincount(q, minlength=rows)
    begin, times = (np.cumsum(times) - times)[p], times[p]
    i = np.repeat(np.arange(len(p)), times)
    j = np.arange(len(i)) - np.repeat(np.cumsum(times) - times - begin, times)
    has = _mix(np.zeros(rows, dtype="uint64"), (n[1::width] > 0).astype("uint64"))
    at, listed, norms = [p[i]], [_mix(_mix(has[p], pt)[i], qt[j])], [pn[i] | qn[j] << 16]
    wide = np.flatnonzero(ways > NARROW)
    if len(wide):
        number = np.full(rows, -1)
        number[wide] = np.arange(len(wide))
        mine = number[place // width]
        those = np.flatnonzero(mine >= 0)
        sums = lambda x: x.reshape(rows, width).sum(1)[wide]
        whole = _Firsts(mine[those], tuple(x[those] for x in weighted), sums(n), sums(may))
        k, t, m = whole.entries(~train_only[wide][whole.place] | whole.seen)
        at.append(wide[k])
        listed.append(_mix(np.uint64(1), t))
        norms.append(m * 0x10001)
    return np.concatenate(at), np.concatenate(listed), np.concatenate(norms), may.reshape(rows, width).sum(1)


def terms(fields: list[tuple[np.ndarray, ...]], train_only: bool) -> tuple[list[int], list[int]]:
    """The lists that a record with these weighted terms stands in, and for each the norms of its two factors, in bytes.

    Of a record without evaluation rows, terms that no evaluation record has are in no list.
    """
    place = np.repeat(np.arange(len(fields)), [len(f[0]) for f in fields])
    _, listed, norms, _ = _lists(place, tuple(map(np.concatenate, zip(*fields))), np.array([train_only]))
    return listed.tolist(), norms.tolist()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = _Numbers()
    sides = np.zeros((2, BUCKETS), dtype="int64")
    seen = np.zeros(BUCKETS, dtype="uint64")
    for b in _chunks(batches):
        place, _, t = _terms(b.columns[2:], numbers)
        at = _buckets(t)
        for side in (0, 1):
            there = np.array(b.columns[side].to_pylist(), dtype=bool)[place // len(FIELDS)]
            sides[side] += np.bincount(at[there], minlength=BUCKETS)
        # Distinct (bucket, bit) pairs of evaluation records, so that the scattered or runs over few.
        pairs = np.unique(at[there] << 6 | (t[there] >> np.uint64(10) & np.uint64(63)).astype("int64"))
        np.bitwise_or.at(seen, pairs >> 6, np.uint64(1) << (pairs & 63).astype("uint64"))
    used = np.flatnonzero(sides.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(s[used]) for s in sides), pa.array(seen[used].view("int64"))], names=["bucket", "nt", "no", "seen"])


def frequencies(texts: DataFrame) -> tuple[list[float], list[int]]:
    """Per bucket the weight of its words (squared), and the words of evaluation records as bits: tables of fixed size."""
    rows = texts.select("train", "other", *FIELDS).mapInArrow(_frequencies, "bucket int, nt bigint, no bigint, seen bigint")
    rows = rows.groupBy("bucket").agg(F.sum("nt").alias("nt"), F.sum("no").alias("no"), F.bit_or("seen").alias("seen")).toPandas()
    # How many pairs a list of the bucket's words would give.
    often = np.zeros(BUCKETS)
    often[rows["bucket"]] = rows["nt"] * rows["no"].astype(float)
    seen = np.zeros(BUCKETS, dtype="int64")
    seen[rows["bucket"]] = rows["seen"]
    return (1.0 + np.log2((1.0 + often.max(initial=0.0)) / (1.0 + often)) / 8).tolist(), seen.view("uint64").tolist()


def _vectors(shared):
    """One row per class and list, with the norms at its words, the parity bits of all words and how many may differ, and one row per class with its word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = Terms(*shared.value), _Numbers()
        names = ["cls", "train", "other", "term", "norms", "low", "high", "size", "may", "counts"]
        for b in _chunks(batches):
            rows = b.num_rows
            place, h, t = _terms(b.columns[3:], numbers)
            at, listed, norms, may = _lists(place, known.of(t), ~np.array(b.columns[2].to_pylist(), dtype=bool))
            row, bit = place // len(FIELDS), (t >> np.uint64(57)).astype("int64")
            parity = np.bincount(row << 7 | bit, minlength=rows << 7).astype("uint8") & 1
            bits = np.packbits(parity.reshape(rows, 128), axis=1, bitorder="little").view("<i8")
            counts = np.bincount(place << 3 | (h & np.uint64(7)).astype("int64"), minlength=rows * len(FIELDS) << 3).astype("int32")
            # Sizes are compared; very long records share the largest, which drops none of their pairs.
            short = lambda x: np.minimum(x, 32767).astype("int16")
            facts = [bits[:, 0], bits[:, 1], short(np.bincount(row, minlength=rows)), short(may)]
            again = pa.array(at)
            entries = [pa.array(listed.view("int64")), pa.array(norms.astype("uint32").view("int32"))]
            yield pa.RecordBatch.from_arrays([*(c.take(again) for c in b.columns[:3]), *entries, *(pa.array(f[at]) for f in facts), pa.nulls(len(at), pa.list_(pa.int32()))], names=names)
            keep = np.flatnonzero(np.bincount(at, minlength=rows))
            n, width = len(keep), len(FIELDS) << 3
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(counts.reshape(rows, width)[keep].ravel()))
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep)) for c in b.columns[:3]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), *(pa.array(f[keep]) for f in facts), lists], names=names)

    return run


def _bag_key(w: str) -> str:
    return w if len(w) < 4 or w.isdigit() else w[0] + "".join(sorted(w[1:]))


def _bag(ws: list[str]) -> Counter:
    return Counter(map(_bag_key, ws))


def allowed(n: int) -> int:
    """How many words may differ in a field of ``n`` words (the longer one's)."""
    return 0 if n < 4 else 1 if n < 8 else max(2, int(0.15 * n))


def same_field(a: list[str], b: list[str]) -> tuple[bool, int]:
    """Whether two fields agree but for a few words, and how many differ."""
    x, y = _bag(a), _bag(b)
    n = max(len(a), len(b))
    changed = max((x - y).total(), (y - x).total())
    return changed <= allowed(n), changed


def same_record(a: tuple[str | None, ...], b: tuple[str | None, ...]) -> bool:
    """The definition: all three fields agree apart from formatting and a few changed, added or dropped words."""
    changed = size = 0
    for x, y in zip(a, b):
        if x == y:
            size += len(x or "") // 6
            continue
        p, q = words(x), words(y)
        ok, n = same_field(p, q)
        if not ok:
            return False
        changed += n
        size += max(len(p), len(q))
    return changed <= max(2, int(0.12 * size))


def cosine(a: tuple[str | None, ...], b: tuple[str | None, ...], weight: list[float], memo: dict[str, int]) -> float:
    """The weighted cosine of two records over the words of all three fields, from exact dot products."""
    x, y = ({t for k, text in enumerate(r) for t in tokens(hashes(text, memo), k)} for r in (a, b))
    w = lambda ts: sum(weight[_bucket(t)] for t in ts)
    norms = w(x) * w(y)
    return w(x & y) / norms**0.5 if norms else 1.0


def _verify(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, memo = shared.value[0], {}
        for b in batches:
            cols, at, scores = [c.to_pylist() for c in b.columns[2:]], [], []
            for k, (ai, ac, ar, bi, bc, br) in enumerate(zip(*cols)):
                if same_record((ai, ac, ar), (bi, bc, br)):
                    at.append(k)
                    scores.append(cosine((ai, ac, ar), (bi, bc, br), weight, memo))
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in b.columns[:2]), pa.array(scores, pa.float64())], names=["a", "b", "cosine"])

    return run


def _may_agree(x: Column, y: Column) -> Column:
    """What :func:`same_field` needs at least: bucket counts may differ by no more words than a field may."""
    ok = F.lit(True)
    for k in range(len(FIELDS)):
        p, q = F.slice(x, 8 * k + 1, 8), F.slice(y, 8 * k + 1, 8)
        total = lambda a: F.aggregate(a, F.lit(0), lambda s, v: s + v)
        more = lambda a, b: total(F.zip_with(a, b, lambda u, v: F.greatest(u - v, F.lit(0))))
        n = F.greatest(total(p), total(q))
        allowed = F.when(n < 4, 0).when(n < 8, 1).otherwise(F.greatest(F.lit(2), F.floor(0.15 * n).cast("int")))
        ok = ok & (F.greatest(more(p, q), more(q, p)) <= allowed)
    return ok


def _norm(side: str, byte: int) -> Column:
    return F.shiftrightunsigned(F.col(f"norms_{side}"), 8 * byte).bitwiseAND(F.lit(255))


def candidates(vectors: DataFrame) -> DataFrame:
    """``a, b``: classes with training rows and classes with evaluation rows that meet in the inverted lists."""
    side = lambda flag, k: vectors.where(flag).where("term is not null").select("term", *[F.col(c).alias(f"{c}_{k}") for c in ("cls", "norms", "low", "high", "size", "may")])
    # Every word that differs flips one bit, and each side has no more of them than its fields may have.
    flipped = F.bit_count(F.col("low_a").bitwiseXOR(F.col("low_b"))) + F.bit_count(F.col("high_a").bitwiseXOR(F.col("high_b")))
    close = (flipped <= F.col("may_a").cast("int") + F.col("may_b")) & (F.abs(F.col("size_a") - F.col("size_b")) <= F.greatest("may_a", "may_b"))
    # Residual norms are logarithms: half their sum bounds the dot product, for each of the two factors.
    reach = [_norm("a", 2 * k) + _norm("b", 2 * k) >= 2 * F.greatest(_norm("a", 2 * k + 1), _norm("b", 2 * k + 1)) for k in (0, 1)]
    met = side("train", "a").join(side("other", "b"), "term").where((F.col("cls_a") != F.col("cls_b")) & reach[0] & reach[1] & close)
    sums = met.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()
    # Texts are only fetched for pairs whose word counts allow all three fields to agree.
    sizes = vectors.where("counts is not null")
    sums = sums.join(sizes.where("other").select(F.col("cls").alias("b"), F.col("counts").alias("cb")), "b")
    sums = sums.join(sizes.where("train").select(F.col("cls").alias("a"), F.col("counts").alias("ca")), "a")
    return sums.where(_may_agree(F.col("ca"), F.col("cb"))).select("a", "b")


def records(train: DataFrame, validation: DataFrame, test: DataFrame) -> DataFrame:
    part = lambda df, name: df.select(F.col("gold_idx").cast("bigint").alias("gold_idx"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in FIELDS], F.col("source_name").cast("string").alias("source_name"), F.lit(name).alias("split"))
    return part(train, "train").unionByName(part(validation, "validation")).unionByName(part(test, "test"))


def class_pairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members ``gold_idx, split, source_name, cls`` and pairs ``a, b, cosine`` of classes (a with training rows, b with others).

    This is the operator's whole result: classes are named by their first record, so ``a`` and ``b`` are pairs of
    representatives, and a class that has rows of both kinds is paired with itself.
    """
    spark = rows.sparkSession
    keys = materialize(keyed(rows, "gold_idx", ("split", "source_name")), "p6-keys")
    train = F.col("split") == "train"
    each = keys.groupBy("plain_key").agg(F.min("struct_key").alias("struct_key"), F.min("idx").alias("first"), F.max(train).alias("train"), F.max(~train).alias("other"))
    each = each.withColumn("key", F.coalesce("struct_key", "plain_key"))
    groups = each.groupBy("key").agg(F.min("first").alias("cls"), F.max("train").alias("train"), F.max("other").alias("other"))
    classes = each.select("plain_key", "key").join(groups, "key").drop("key")
    members = materialize(keys.join(classes, "plain_key").select(F.col("idx").alias("gold_idx"), "split", "source_name", "cls", "train", "other"), "p6-members")
    heads = members.where("gold_idx = cls").select("cls", "train", "other").distinct()
    texts = materialize(rows.join(heads, rows["gold_idx"] == heads["cls"]).select("cls", "train", "other", *FIELDS).dropDuplicates(["cls"]), "p6-texts")
    # Two tables of BUCKETS numbers, whatever the data.
    shared = spark.sparkContext.broadcast(frequencies(texts))
    vectors = materialize(texts.select("cls", "train", "other", *FIELDS).mapInArrow(_vectors(shared), "cls bigint, train boolean, other boolean, term bigint, norms int, low bigint, high bigint, size smallint, may smallint, counts array<int>"), "p6-vectors")
    met = materialize(candidates(vectors), "p6-met")
    forget(vectors)
    left = texts.where("train").select(F.col("cls").alias("a"), *[F.col(f).alias(f"a_{f}") for f in FIELDS])
    right = texts.where("other").select(F.col("cls").alias("b"), *[F.col(f).alias(f"b_{f}") for f in FIELDS])
    held = met.join(right, "b").join(left, "a").select("a", "b", *[f"a_{f}" for f in FIELDS], *[f"b_{f}" for f in FIELDS])
    near = materialize(held.mapInArrow(_verify(shared), "a bigint, b bigint, cosine double"), "p6-near")
    same = members.where("train and other").select(F.col("cls").alias("a"), F.col("cls").alias("b"), F.lit(1.0).alias("cosine")).distinct()
    return members, near.unionByName(same)


def linked(train: DataFrame, validation: DataFrame, test: DataFrame) -> DataFrame:
    """``gold_idx, split, source_name, cls, links``: every record with its class and the number of classes that one is paired with."""
    members, found = class_pairs(records(train, validation, test))
    both = found.select(F.col("a").alias("cls"), F.col("b").alias("to")).unionByName(found.select(F.col("b").alias("cls"), F.col("a").alias("to"))).distinct()
    n = both.groupBy("cls").agg(F.count(F.lit(1)).alias("links"))
    return members.join(n, "cls", "left").select("gold_idx", "split", "source_name", "cls", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def pairs(train: DataFrame, validation: DataFrame, test: DataFrame) -> DataFrame:
    """``lo_idx, hi_idx, split, source_name, cosine`` (split and source of the evaluation row) of every overlapping pair of rows."""
    members, found = class_pairs(records(train, validation, test))
    t = members.where("split = 'train'").select(F.col("cls").alias("a"), F.col("gold_idx").alias("t_idx"))
    e = members.where("split <> 'train'").select(F.col("cls").alias("b"), F.col("gold_idx").alias("e_idx"), "split", "source_name")
    return found.join(t, "a").join(e, "b").select(F.least("t_idx", "e_idx").alias("lo_idx"), F.greatest("t_idx", "e_idx").alias("hi_idx"), "split", "source_name", "cosine")


def report(train: DataFrame, validation: DataFrame, test: DataFrame) -> DataFrame:
    """``split, source_name, pairs``: overlaps of rows per evaluation split and source, counted on the classes."""
    members, found = class_pairs(records(train, validation, test))
    t = members.where("split = 'train'").groupBy(F.col("cls").alias("a")).agg(F.count(F.lit(1)).alias("nt"))
    e = members.where("split <> 'train'").groupBy(F.col("cls").alias("b"), "split", "source_name").agg(F.count(F.lit(1)).alias("ne"))
    return found.join(t, "a").join(e, "b").groupBy("split", "source_name").agg(F.sum(F.col("nt") * F.col("ne")).alias("pairs"))

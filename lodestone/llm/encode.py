"""Spark side of the tokenizer: ids of every document (problem 7), token counts, pieces of long documents (problem 9).

Each operator is one pass of ``mapInArrow`` over the documents, without a shuffle. The vocabulary goes to the executors
as a broadcast; its size is that of the vocabulary file (about 1 MB, checked on loading), whatever the data.

Defined cases: a null text and an empty text both give an empty list of ids and the count 0; special-token look-alikes
are ordinary text; repeated ``doc_id`` give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.vocab import Vocabulary, default_path, pre_tokens

MAX_VOCAB_ENTRIES = 1_000_000
# A pre-token of more tokens than this is offered for cutting between its characters.
LONG_WORD_TOKENS = 32
BATCH_ROWS = 1024


@functools.lru_cache(maxsize=4)
def _vocabulary(path: str) -> Vocabulary:
    v = Vocabulary.load(path)
    if len(v.ranks) > MAX_VOCAB_ENTRIES:
        raise ValueError("the vocabulary is too large to broadcast")
    return v


_broadcasts: dict = {}


def shared_vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary as a broadcast, one for each session and file."""
    path = path or default_path()
    key = (spark.sparkContext.applicationId, path)
    if key not in _broadcasts:
        _broadcasts[key] = spark.sparkContext.broadcast(_vocabulary(path))
    return _broadcasts[key]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(at, BATCH_ROWS)


def _as_int_lists(lists: list) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def token_ids(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """``doc_id, ids``."""
    vocab = shared_vocabulary(docs.sparkSession, vocab_path)

    def run(batches):
        encode = vocab.value.encode
        for b in _slices(batches):
            ids = [encode(t) if t else () for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), _as_int_lists(ids)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def token_counts(df: DataFrame, text: str, keep: tuple[str, ...], vocab_path: str | None = None) -> DataFrame:
    """The ``keep`` columns and ``n_tokens`` of ``text``."""
    vocab = shared_vocabulary(df.sparkSession, vocab_path)
    picked = df.select(F.col(text).alias("_text"), *keep)

    def run(batches):
        count = vocab.value.count
        for b in _slices(batches):
            n = pa.array([count(t) if t else 0 for t in b.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], n], names=[*b.schema.names[1:], "n_tokens"])

    schema = ", ".join(f"`{c}` {t}" for c, t in picked.dtypes[1:])
    return picked.mapInArrow(run, f"{schema}, n_tokens bigint")


_ENDS = frozenset(".!?…。！？")
_CLOSERS = "\"'”’»)]*_`"


def _skeleton(text: str, vocab: Vocabulary) -> tuple[str, list[int], list[int]]:
    """One letter for each token of the text, and for each the characters and the bytes up to the end of its unit.

    A unit is a pre-token, or one character of a pre-token of many tokens (which then counts its bytes, an upper bound
    of what any substring of it encodes to). The last letter of a unit says how natural a cut behind it is: P after a
    blank line, L after a line, S after a sentence, W before white space, x elsewhere; the others are '-'.
    """
    marks, ends, at, sizes, size = [], [], 0, [], 0
    words = pre_tokens(text)
    words.append(" ")
    memo = vocab.memo
    for w, following in zip(words, words[1:]):
        n = len(memo[w])
        if n > LONG_WORD_TOKENS:
            for c in w:
                at += 1
                n = len(c.encode("utf-8"))
                size += n
                marks.append("-" * (n - 1) + "x")
                ends += [at] * n
                sizes += [size] * n
            continue
        at += len(w)
        size += len(w) if w.isascii() else len(w.encode("utf-8"))
        if w.isspace():
            breaks = w.count("\n") + w.count("\r") - w.count("\r\n")
            kind = "-" if following.isspace() and at < len(text) else "P" if breaks > 1 else "L" if breaks else "W"
        elif following[:1].isspace():
            bare = w.rstrip(_CLOSERS)
            kind = "S" if bare[-1:] in _ENDS and bare else "W"
        else:
            kind = "S" if w[-1] in "。！？" else "x"
        marks.append("-" * (n - 1) + kind)
        ends += [at] * n
        sizes += [size] * n
    return "".join(marks), ends, sizes


def measured(docs: DataFrame, max_tokens: int, vocab_path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, text, skeleton, char_ends, byte_ends``: the documents of more than ``max_tokens`` tokens."""
    vocab = shared_vocabulary(docs.sparkSession, vocab_path)

    def run(batches):
        v = vocab.value
        for b in _slices(batches):
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # A token has at least one byte, so a text of few bytes needs no counting.
                if text and len(text) * 4 > max_tokens and len(text.encode("utf-8")) > max_tokens and (n := v.count(text)) > max_tokens:
                    rows.append((doc, n, text, *_skeleton(text, v)))
            if rows:
                doc, n, text, marks, ends, sizes = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array([t.encode("utf-8") for t in text]), pa.array(marks), _as_int_lists(ends), _as_int_lists(sizes)],
                    names=["doc_id", "n_tokens", "text", "skeleton", "char_ends", "byte_ends"],
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, text binary, skeleton string, char_ends array<int>, byte_ends array<int>"
    )


def boundary_pattern(room: int) -> str:
    """Takes the rest if it fits, else up to ``room`` letters ending at the strongest boundary of the second half."""
    half, most = room // 2, room - 1
    return "|".join([rf".{{1,{room}}}\z", *(f".{{{half},{most}}}{k}" for k in "PLSW"), f".{{0,{most}}}[^-]"])


def pieces(docs: DataFrame, max_tokens: int, overlap_tokens: int, vocab_path: str | None = None) -> DataFrame:
    """``doc_id, piece_no, n_tokens, start_char, end_char, piece``: every long document in overlapping pieces.

    Method: a regular expression with bounded quantifiers runs over the document's skeleton; its alternatives are
    ordered by boundary strength and its last one falls back to characters. Each piece starts ``overlap_tokens`` before
    the end of its neighbour, or at the first place behind that where a unit ends, so the shared part never exceeds the
    overlap. ``n_tokens`` is the document's own count; all pieces hold at most ``max_tokens`` tokens.
    """
    if not 0 <= overlap_tokens < max_tokens - 4 * LONG_WORD_TOKENS:
        raise ValueError("the overlap leaves no room in a piece")
    room = max_tokens - overlap_tokens
    found = F.expr(f"regexp_extract_all(skeleton, r'{boundary_pattern(room)}', 0)")
    at = lambda ends, token: F.when(token <= 0, 0).otherwise(F.try_element_at(ends, token.cast("int")))

    def ends_of(parts):
        add = lambda acc, part: F.concat(acc, F.array((F.length(part) + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))).cast("int")))
        return F.aggregate(parts, F.array().cast("array<int>"), add)

    def checked(ends):
        whole = F.try_element_at(ends, F.lit(-1)) == F.length("skeleton")
        return F.when(whole, ends).otherwise(F.raise_error(F.lit("the pieces do not cover their document")).cast("array<int>"))

    def pieces_of(ends):
        def piece(end, i):
            start = F.when(i == 0, 0).otherwise(F.get(ends, i - 1) - overlap_tokens)
            first, last = at(F.col("byte_ends"), start), at(F.col("byte_ends"), end)
            # Bytes are cut, as characters would be counted from the beginning of the text each time.
            return F.struct(i.alias("piece_no"), at(F.col("char_ends"), start).alias("start_char"), at(F.col("char_ends"), end).alias("end_char"), F.substring("text", first + 1, last - first).cast("string").alias("piece"))

        return F.transform(checked(ends), piece)

    # An array of one passes a value on without computing it again. Pieces are built inside the generator, before they
    # become rows, so no row carries the text of its document.
    made = F.flatten(F.transform(F.array(ends_of(found)), pieces_of))
    return measured(docs, max_tokens, vocab_path).select("doc_id", "n_tokens", F.inline(made))


def limits(size_limits: DataFrame, table: str) -> tuple[int, int]:
    row = size_limits.where(F.col("table_name") == table).select("max_tokens", "overlap_tokens").first()
    if row is None:
        raise ValueError(f"size_limits has no row for {table}")
    return int(row[0]), int(row[1])

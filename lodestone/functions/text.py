"""Text expressions. White space is what Python's ``str.isspace`` accepts, spelled out so that no engine's \\s matters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"[\t-\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# The same characters for trimming, which looks at the ends of a text only.
WS_CHARS = "".join(map(chr, (*range(0x09, 0x0E), 0x20, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
WORD = r"[\p{L}\p{N}_]"
# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def text(c: Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def _ends_blank(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1))).rlike(WS)


def strip(c: Column) -> Column:
    # Trimming a set of characters copies the text into arrays, so it is done only where an end asks for it.
    return F.when(_ends_blank(c), F.btrim(c, F.lit(WS_CHARS))).otherwise(c)


def _blank_runs(c: Column) -> Column:
    return c.contains("  ") | c.contains("\t")


def one_blank(c: Column) -> Column:
    """Runs of blanks and tabs to one blank; single blanks, the common case, are not matched."""
    return F.regexp_replace(c, r"[ \t]{2,}|\t", " ")


def clean_text(c: Column) -> Column:
    """Line ends to LF, runs of blanks to one, three or more line ends to two, stripped; null becomes ''.

    Byte searches decide which texts need the replacements at all.
    """
    t = text(c)
    x = F.regexp_replace(t, r"\r\n?", "\n")
    x = F.regexp_replace(one_blank(x), r"\n{3,}", "\n\n")
    return F.when(t.contains("\r") | _blank_runs(t) | t.contains("\n\n\n") | _ends_blank(t), F.btrim(x, F.lit(WS_CHARS))).otherwise(t)


def canonical_text(c: Column) -> Column:
    """The form that is hashed: stripped, lower case, blanks collapsed; line ends stay."""
    return F.when(_blank_runs(c) | _ends_blank(c), one_blank(F.lower(F.btrim(c, F.lit(WS_CHARS))))).otherwise(F.lower(c))


def content_hash(instruction: Column, context: Column, response: Column) -> Column:
    return F.sha2(F.concat_ws("\u001f", *[canonical_text(text(c)) for c in (instruction, context, response)]), 256)


def normalize_answer(c: Column) -> Column:
    """Lower case, ASCII punctuation deleted, articles to blanks, white space collapsed, stripped."""
    x = F.translate(F.lower(text(c)), PUNCTUATION, "")
    x = F.regexp_replace(x, rf"(?<!{WORD})(?:a|an|the)(?!{WORD})", " ")
    return strip(F.regexp_replace(x, rf"{WS}{{2,}}|(?! ){WS}", " "))


def answer_tokens(c: Column) -> Column:
    return F.filter(F.split(normalize_answer(c), " "), lambda t: t != "")


def whitespace_tokens(c: Column) -> Column:
    return F.filter(F.split(text(c), rf"{WS}+"), lambda t: t != "")


def truncated_param(c: Column, limit: int = 490) -> Column:
    """Longer than ``limit``: cut to fit three dots."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def metric_key(c: Column) -> Column:
    """``eval_x`` becomes ``eval/x``, any other key ``train/key``."""
    return F.when(c.startswith("eval_"), F.concat(F.lit("eval/"), F.substring(c, 6, 1 << 30))).otherwise(F.concat(F.lit("train/"), c))


def short_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def is_three_level(c: Column) -> Column:
    """Whether a model name is catalog.schema.name."""
    return F.length(c) - F.length(F.replace(c, F.lit("."), F.lit(""))) == 2


def flat_path(c: Column) -> Column:
    """An experiment path for a store without folders."""
    return F.replace(F.regexp_replace(c, r"^/+|/+\z", ""), F.lit("/"), F.lit("-"))


# A type object, as workers import this module without a session that could parse a string.
_MATCHES = T.StructType([T.StructField("common", T.IntegerType()), T.StructField("lcs", T.IntegerType())])


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence, bit-parallel: one big-integer step for each token of ``b``."""
    at: dict = {}
    for i, t in enumerate(a):
        at[t] = at.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for t in b:
        u = v & at.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def overlap(a: list, b: list) -> int:
    """Size of the multiset intersection."""
    counts: dict = {}
    for t in a:
        counts[t] = counts.get(t, 0) + 1
    n = 0
    for t in b:
        if counts.get(t, 0) > 0:
            counts[t] -= 1
            n += 1
    return n


@F.pandas_udf(_MATCHES)
def token_matches(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Multiset overlap and longest common subsequence of two token arrays, linear where expressions are quadratic."""
    for p, r in pairs:
        rows = [(overlap(x, y), lcs_length(x, y)) for x, y in zip((list(v) for v in p), (list(v) for v in r))]
        yield pd.DataFrame(rows, columns=["common", "lcs"])

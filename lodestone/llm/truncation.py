"""Values cut off by field limits (problem 2).

Method: prefix self-join by sorting. The distinct values, reduced to letters and digits, are sorted over the cluster; a
value is a strict prefix of some longer one exactly if the next value in that order begins with it, so one sorted pass
finds every such pair without forming groups (a prefix shared by a third of all values costs nothing extra). Each value
also gets a verdict from its own end:

* ``cut``: it ends inside a JSON object, a code block, a list mark, after a comma or another joining mark, or, in a text
  whose other sentences end with a stop, inside a sentence;
* ``whole``: it ends with a stop, a closed structure or a signature;
* ``open``: its end alone does not tell: a list, lines of ``name: value``, bare code, a phrase without any stop, dots.

Open values are settled by what the corpus ends such values with: the last words of inner list items, of values of named
lines, of code blocks and of sentences are counted over all rows; an end that never occurs there is a cut. A sentence that
trails off in dots is whole if several different values end with it and no sentence begins like it ("to be continued"). And an
open value of any length, whatever its end, is cut if the self-join shows it as a strict prefix that stops inside a word of
longer copies, and these are delivered at least as often.

Defined cases: null, empty and blank values and values without letters or digits are missing, never cut; equal values
get equal verdicts, so repeated rows are all reported; ``row_key`` need not be unique; an empty table gives no rows;
other columns are ignored; texts are processed whole whatever their length.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.ledger import letters
from lodestone.session import materialize

CUT, WHOLE, OPEN, MISSING = "cut", "whole", "open", "missing"
# An end counts as natural from this many occurrences in the corpus.
MIN_SEEN = 2
DISTINCT_DOTTED = 3
SHORT_WORDS = 4
# Shorter beginnings, in letters, are no evidence.
SHORTEST = 6

_EDGE = " \t\r\n\v\f\x00\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u200c\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
_QUOTES = "\"'”’»«“‘)]}*_`>"
_WORD = re.compile(r"[^\W_]+")
_GAPS = re.compile(r"[\W_]+")
_STOP = re.compile(r"[.!?。！？]+[\"'”’»)\]*_`]*(?:\s+|$)")
_ITEM = re.compile(r"^\s*(?:[-*•–+]|\d{1,3}[.)])\s+(?=\S)")
_NAMED = re.compile(r"^([^\W\d_][\w ]{0,24}?)\s*:\s*(\S.*)$")
_CODE = re.compile(r"^\s*(?:(?:async )?def|class|function)\s+\w+\s*[(:]|^\s*(?:import|from)\s+\w+(?:\s+import\b|\s*$)|^\s*for\s+[\w, ]+\s+in\s+\w+.*:|^\s*(?:const|let|var)\s+\w+\s*=|^\s*select\s.+\sfrom\s", re.M)
_SIGNED = re.compile(r"^\s*(?:[—–]|--|\(|\[|©|Text ©|By |Source:|Author:)\s*\S")


def _tail(words: list[str], n: int = 2) -> str:
    return " ".join("0" if w.isdigit() else w for w in words[-n:])


def _json_closed(s: str) -> bool:
    depth, inside, skip, closed = 0, False, False, False
    for c in s:
        if skip:
            skip = False
        elif inside:
            if c == "\\":
                skip = True
            elif c == '"':
                inside = False
        elif c == '"':
            inside = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            closed = closed or depth <= 0
    return closed and depth <= 0 and not inside


def inspect(text: str | None) -> tuple[str, str | None, list[str]]:
    """The verdict of one value, the end to look up if it is open, and the natural ends it shows to others."""
    if text is None:
        return MISSING, None, []
    s = text.strip(_EDGE)
    if not _WORD.search(s):
        return MISSING, None, []
    low = s.lower()
    if s[-1] == "�":
        return CUT, None, []
    if "```" in s:
        parts = low.split("```")
        shown = [f"C|{_tail(w)}" for p in parts[1:-1:2] if (w := _WORD.findall(p.strip().rsplit("\n", 1)[-1]))]
        return (CUT if len(parts) % 2 == 0 or s.endswith("``") and not s.endswith("```") else WHOLE), None, shown
    if s[0] == "{" or s[0] == "[" and s[1:2] in '{"[':
        if _json_closed(s):
            shown = [f"K|{_tail(w, 1)}" for v in re.findall(r':\s*"([^"]*)"', low) if len(w := _WORD.findall(v)) > 1]
            return WHOLE, None, shown
        return CUT, None, []
    lines = [x for x in low.split("\n") if x.strip(_EDGE)] if "\n" in low else [low]
    lines = [y for x in lines for y in re.split("[\r\x85\u2028\u2029]", x) if y.strip(_EDGE)]
    items = [_ITEM.sub("", x).strip(_EDGE) for x in lines]
    listed = sum(a.strip(_EDGE) != b for a, b in zip(lines, items))
    named = [_NAMED.match(x) for x in items]
    if all(m or i == len(named) - 1 for i, m in enumerate(named)) and (len(lines) > 1 or named[0] and not _STOP.search(low) and len(_WORD.findall(low)) <= 6):
        shown = [f"K|{_tail(w, 1)}" for m in named[:-1] if m and len(w := _WORD.findall(m[2])) > 1]
        last = named[-1]
        if last is None:
            return (CUT if len(_WORD.findall(items[-1])) <= 2 and len(lines) > 1 else WHOLE if s[-1] in ".!?" else OPEN), f"S|{_tail(_WORD.findall(items[-1]))}", shown
        words = _WORD.findall(last[2])
        if not words:
            return CUT, None, shown
        if len(words) == 1 or words[-1].isdigit():
            return WHOLE, None, shown
        return OPEN, f"K|{_tail(words, 1)}", shown
    if listed and (listed > 1 or len(lines) == 1):
        wrapped = listed < len(lines)
        shown = [] if wrapped else [f"L|{_tail(w)}" for x in items[:-1] if (w := _WORD.findall(x))]
        if lines[-1].strip(_EDGE) in ("-", "*", "•") or not (words := _WORD.findall(items[-1])) or re.fullmatch(r"\d{1,3}[.)]?", lines[-1].strip(_EDGE)):
            return CUT, None, shown
        if s[-1] in ".!?;" and not s.endswith("..."):
            return WHOLE, None, shown
        return OPEN, f"L|{_tail(words)}", shown
    if _CODE.search(low) and not _STOP.search(low.rsplit("\n", 1)[-1]):
        opened = sum(s.count(a) - s.count(b) for a, b in ("()", "[]", "{}"))
        last = lines[-1].strip(_EDGE)
        if opened > 0 or last[-1] in ":,=+-*/([{.":
            return CUT, None, []
        return OPEN, f"C|{_tail(_WORD.findall(last))}", []
    sentences, at = [], 0
    for m in _STOP.finditer(low):
        sentences.append(low[at : m.start()])
        at = m.end()
    rest = low[at:]
    shown = [g for x in sentences if len(w := _WORD.findall(x)) > 2 for g in (f"S|{_tail(w)}", f"B|{_tail(w[:3], 3)}")]
    bare = s.rstrip(_QUOTES + _EDGE)
    if s.endswith("...") or s[-1] == "…" or bare[-1:] == "…" or bare.endswith("..."):
        dotted = rest if rest.strip(_EDGE) and _WORD.search(rest) else sentences[-1] if sentences else ""
        return OPEN, f"E|{' '.join(_WORD.findall(dotted))}", shown if dotted is rest else shown[:-2]
    if not bare or bare[-1] in ".!?。！？":
        return WHOLE, None, shown
    if s[-1] in ",;:—–-(/&=" or bare[-1] in ",;—–-(/&=":
        return CUT, None, shown
    words = _WORD.findall(rest)
    if sentences:
        last_line = s.rsplit("\n", 1)[-1]
        if "\n" in s and _SIGNED.match(last_line) and len(last_line) <= len(rest) + 1:
            return WHOLE, None, shown
        return (CUT if len(sentences) > 1 or len(words) > 1 or s[-1].isalpha() else OPEN), f"S|{_tail(words)}", shown
    if len(words) <= SHORT_WORDS:
        return OPEN, "", shown
    if s[0].isupper() and not s.isupper() and not s.istitle():
        return CUT, None, shown
    return OPEN, f"S|{_tail(words)}", shown


def inspected(values: DataFrame) -> DataFrame:
    """``values`` (field_name, row_key, origin, text) with ``verdict, tail, norm``; rows with ``seen`` carry shown ends.

    ``norm`` is the digest of an open value's letters and digits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["field_name", "row_key", "origin", "verdict", "tail", "norm", "seen"]
        for b in batches:
            verdicts, tails, norms, shown = [], [], [], Counter()
            for t in b.column(3).to_pylist():
                v, tail, ends = inspect(t)
                verdicts.append(v)
                tails.append(tail)
                shown.update(ends)
                norms.append(hashlib.md5(_GAPS.sub("", t.upper()).encode()).hexdigest() if v == OPEN else None)
            n, k = b.num_rows, len(shown)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(x, pa.string()) for x in (verdicts, tails, norms)), pa.nulls(n, pa.int64())], names=names)
            if k:
                none = pa.nulls(k, pa.string())
                yield pa.RecordBatch.from_arrays([none, pa.nulls(k, pa.int64()), none, none, pa.array(list(shown), pa.string()), none, pa.array(list(shown.values()), pa.int64())], names=names)

    return values.select("field_name", "row_key", "origin", "text").mapInArrow(run, "field_name string, row_key bigint, origin string, verdict string, tail string, norm string, seen bigint")


def strict_prefixes(texts: DataFrame) -> DataFrame:
    """``norm``: the distinct values of column ``norm`` that are strict prefixes of another one.

    One range-partitioned sort; the neighbours across partition borders are compared in a frame of one row a partition.
    """
    # Written once: finding the range borders reads the values a first time, the sort a second.
    values = materialize(texts.where("norm <> ''").select("norm").distinct(), "p2-values")
    ordered = values.repartitionByRange("norm").sortWithinPartitions("norm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first, last = TaskContext.get().partitionId(), None, None
        for b in batches:
            hit = []
            for x in b.column(0).to_pylist():
                if last is None:
                    first = x
                elif x.startswith(last):
                    hit.append(last)
                last = x
            if hit:
                yield pa.RecordBatch.from_arrays([pa.array(hit), pa.nulls(len(hit), pa.string()), pa.nulls(len(hit), pa.int32())], names=["norm", "first", "part"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([first]), pa.array([part], pa.int32())], names=["norm", "first", "part"])

    found = materialize(ordered.mapInArrow(run, "norm string, first string, part int"), "p2-prefixes")
    borders = found.where("part is not null").withColumn("next_first", F.lead("first").over(Window.orderBy("part")))
    over = borders.where(F.col("next_first").startswith(F.col("norm")) & (F.col("next_first") != F.col("norm"))).select("norm")
    return found.where("part is null").select("norm").unionByName(over).distinct()


def _starts(letters_: Column) -> Column:
    """The beginnings of 6, 12, 24, ... letters that a value has, as hashes."""
    lengths = F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.length(letters_) / SHORTEST)).cast("int")), lambda k: (SHORTEST * F.pow(F.lit(2), k)).cast("int"))
    return F.transform(lengths, lambda n: F.xxhash64(n, F.left(letters_, n)))


def inside_a_word(values: DataFrame, stubs: DataFrame) -> DataFrame:
    """``norm``: the stubs that stop inside a word of longer values which are delivered at least as often.

    A stub meets the values that share its longest beginning of 6, 12, 24, ... letters, which is at least half of it.
    """
    keys = stubs.select("norm", F.element_at(_starts(F.col("norm")), -1).alias("start"))
    form = F.trim(F.regexp_replace(F.upper("text"), r"[^\p{L}\p{N}]+", " "))
    pool = values.where(F.col("text").isNotNull()).select(form.alias("form"), F.concat_ws(":", "field_name", "delivery").alias("delivery"))
    pool = pool.withColumn("letters", F.replace("form", F.lit(" "), F.lit(""))).where(F.length("letters") >= SHORTEST)
    pool = pool.select("letters", "form", "delivery", F.explode(_starts(F.col("letters"))).alias("start"))
    pool = materialize(pool.join(keys.select("start").distinct(), "start", "left_semi").distinct(), "p2-pool")
    held = pool.join(keys, "start").where(F.col("letters") == F.col("norm")).drop("letters")
    own = held.groupBy("norm").agg(F.count_distinct("delivery").alias("times"))
    forms = held.select("start", "norm", F.col("form").alias("stub_form")).distinct()
    goes_on = F.col("form").startswith(F.col("stub_form")) & (F.length("form") > F.length("stub_form")) & (F.expr("substring(form, length(stub_form) + 1, 1)") != " ")
    longer = forms.join(pool, "start").where(goes_on).groupBy("norm").agg(F.count_distinct("delivery").alias("longer"))
    return own.join(longer, "norm").where("times <= longer").select("norm")


def judged(values: DataFrame) -> DataFrame:
    """``field_name, row_key, origin, truncated`` for every value that is not missing."""
    seen = materialize(inspected(values), "p2-ends")
    natural = seen.where("seen is not null").groupBy("tail").agg(F.sum("seen").alias("times")).where(F.col("times") >= MIN_SEEN).select(F.col("tail").alias("known"))
    rows = seen.where("seen is null and verdict <> 'missing'")
    dotted = rows.where("verdict = 'open' and tail like 'E|%'").select("field_name", "row_key", "origin", "verdict", "tail", "norm")
    ask = rows.where("verdict = 'open' and tail not like 'E|%'")
    asked = ask.join(natural, F.col("tail") == F.col("known"), "left")
    # An end known from the corpus is whole; a short phrase has no end to look up.
    settled = asked.withColumn("verdict", F.when(F.col("tail") == "", OPEN).when(F.col("known").isNotNull(), WHOLE).otherwise(CUT)).drop("known")
    # Whatever its own end says, an open value that stops inside a word of longer copies was cut.
    candidates = settled.where(F.col("verdict") != CUT).select(F.col("norm").alias("digest")).distinct()
    prefixes = strict_prefixes(values.where(F.col("text").isNotNull()).select(letters(F.col("text")).alias("norm")))
    stubs = prefixes.where(F.length("norm") >= SHORTEST).withColumn("digest", F.md5("norm"))
    stubs = materialize(stubs.join(candidates, "digest", "left_semi").select("norm"), "p2-stubs")
    cut_short = inside_a_word(values, stubs).select(F.md5("norm").alias("norm"), F.lit(True).alias("stub"))
    settled = settled.join(materialize(cut_short, "p2-cut-short"), "norm", "left").withColumn("verdict", F.when(F.col("stub"), CUT).otherwise(F.col("verdict"))).drop("stub")
    # Set phrases before dots: in several different values, of three words or more, and no way to begin a sentence.
    said = dotted.groupBy("tail").agg(F.count_distinct("norm").alias("values")).where((F.col("values") >= DISTINCT_DOTTED) & F.col("tail").rlike(r"^E\|\S+ \S+ \S+"))
    begins = F.concat(F.lit("B|"), F.substring_index(F.regexp_replace(F.substring("tail", 3, 1 << 30), r"(?<!\S)\d+(?!\S)", "0"), " ", 3))
    phrases = said.withColumn("known", begins).join(natural, "known", "left_anti").select("tail", F.lit(True).alias("phrase"))
    dotted = dotted.join(phrases, "tail", "left").select("field_name", "row_key", "origin", F.when(F.col("phrase"), WHOLE).otherwise(CUT).alias("verdict"), "tail")
    columns = ["field_name", "row_key", "origin", "verdict"]
    all_rows = rows.where("verdict <> 'open'").select(*columns).unionByName(settled.select(*columns)).unionByName(dotted.select(*columns))
    return all_rows.select("field_name", "row_key", "origin", (F.col("verdict") == CUT).alias("truncated"))


def value_table(raw: DataFrame, log: DataFrame) -> DataFrame:
    request = F.col("request_id") if "request_id" in log.columns else F.lit(None).cast("string")
    a = raw.select(F.lit("response").alias("field_name"), F.col("_idx").cast("bigint").alias("row_key"), F.col("source_name").alias("origin"), F.col("response").alias("text"), F.coalesce(F.col("id"), F.col("_idx").cast("string")).alias("delivery"))
    b = log.select(F.lit("prediction").alias("field_name"), F.col("log_id").cast("bigint").alias("row_key"), F.col("model").alias("origin"), F.col("prediction").alias("text"), F.coalesce(request, F.col("log_id").cast("string")).alias("delivery"))
    return a.unionByName(b)


def truncated(raw: DataFrame, log: DataFrame) -> DataFrame:
    return judged(value_table(raw, log)).where("truncated").select("field_name", "row_key")


def share_by_origin(raw: DataFrame, log: DataFrame) -> DataFrame:
    """``field_name, origin, values, cut, cut_share``: per source of responses and per model of predictions."""
    g = judged(value_table(raw, log)).groupBy("field_name", "origin")
    return g.agg(F.count(F.lit(1)).alias("values"), F.count_if("truncated").alias("cut")).withColumn("cut_share", F.round(F.col("cut") / F.col("values"), 6))

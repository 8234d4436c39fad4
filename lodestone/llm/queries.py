"""The queries of the training-data problems: name -> (spark, folder) -> DataFrame, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import defects, encode, ledger, mixing, overlap, relations, sampling, truncation


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark, d):
    return ledger.copies(_t(spark, d, "raw_instructions"))


def p1_collapsed(spark, d):
    return ledger.collapsed(_t(spark, d, "raw_instructions"))


def p2_found(spark, d):
    return truncation.truncated(_t(spark, d, "raw_instructions"), _t(spark, d, "predict_log"))


def p2_shares(spark, d):
    return truncation.share_by_origin(_t(spark, d, "raw_instructions"), _t(spark, d, "predict_log"))


def p3_found(spark, d):
    return relations.related(_t(spark, d, "raw_instructions"))


def p3_splits(spark, d):
    return relations.splits(_t(spark, d, "raw_instructions"), _t(spark, d, "split_targets"))


def p3_shares(spark, d):
    return relations.split_shares(_t(spark, d, "raw_instructions"), _t(spark, d, "split_targets"))


def p4_found(spark, d):
    return sampling.sample(_t(spark, d, "raw_instructions"), _t(spark, d, "sample_targets"))[1].where("unmet").select("category")


def p4_report(spark, d):
    return sampling.sample(_t(spark, d, "raw_instructions"), _t(spark, d, "sample_targets"))[1]


def p4_sample(spark, d):
    return sampling.sample(_t(spark, d, "raw_instructions"), _t(spark, d, "sample_targets"))[0]


def p5_found(spark, d):
    return defects.defects(_t(spark, d, "raw_instructions"), _t(spark, d, "predict_log"))


def _splits(spark, d):
    return [_t(spark, d, n) for n in ("train", "validation", "test")]


def p6_found(spark, d):
    return overlap.pairs(*_splits(spark, d)).select("lo_idx", "hi_idx")


def p6_members(spark, d):
    return overlap.linked(*_splits(spark, d))


def p6_report(spark, d):
    return overlap.report(*_splits(spark, d))


def p7_ids(spark, d):
    return encode.token_ids(_t(spark, d, "documents"))


def p8_found(spark, d):
    return mixing.report(_t(spark, d, "documents"), _t(spark, d, "mix_targets")).where("short").select("source")


def p8_report(spark, d):
    return mixing.report(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))


def p8_mixture(spark, d):
    return mixing.mix(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))[0]


def p9_pieces(spark, d):
    return encode.pieces(_t(spark, d, "documents"), *encode.limits(_t(spark, d, "size_limits"), "documents"))


def p9_found(spark, d):
    return p9_pieces(spark, d).where(F.col("piece_no") == 0).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in sorted(globals().items()) if n[0] == "p" and n[1].isdigit()}


_LETTERS = "regexp_replace(upper(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]', '', 'g')"

def _letters(x: str) -> str:
    return _LETTERS.format(c=x)


def _structured(x: str) -> str:
    """Pairs of a JSON object or of lines of ``name: value`` in sorted order, else null."""
    text = f"trim(regexp_replace(coalesce({x}, ''), '\\r\\n?', chr(10), 'g'))"
    pairs = f"list_transform(json_keys({text}), lambda k: {_letters('k')} || {_letters(f"json_extract_string({text}, '$.' || chr(34) || k || chr(34))")})"
    lines = f"list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(l, '\\S'))"
    paired = f"list_bool_and(list_transform({lines}, lambda l: regexp_matches(l, '^[^\\p{{L}}\\p{{N}}:]*[\\p{{L}}\\p{{N}}][^:]*:.*[\\p{{L}}\\p{{N}}]')))"
    return (
        f"CASE WHEN {x} NOT LIKE '%:%' THEN NULL WHEN regexp_matches({text}, '(?s)^\\s*\\{{.*\\}}\\s*$') AND json_valid({text}) THEN '<' || array_to_string(list_sort({pairs}), '<') "
        f"WHEN len({lines}) > 1 AND {paired} THEN '<' || array_to_string(list_sort(list_transform({lines}, lambda l: {_letters('l')})), '<') END"
    )


_THREE = ("instruction", "context", "response")

SQL: dict[str, str] = {
    "p1_found": "WITH f AS (SELECT _idx, "
    + ", ".join(f"{_letters(c)} AS p{k}, {_structured(c)} AS s{k}" for k, c in enumerate(_THREE))
    + """ FROM raw_instructions), k AS (SELECT _idx, p0 || chr(31) || p1 || chr(31) || p2 AS plain, CASE WHEN coalesce(s0, s1, s2) IS NOT NULL THEN coalesce(s0, p0) || chr(31) || coalesce(s1, p1) || chr(31) || coalesce(s2, p2) END AS pairs FROM f),
 c AS (SELECT _idx, coalesce(min(pairs) OVER (PARTITION BY plain), plain) AS canon FROM k), g AS (SELECT _idx, min(_idx) OVER (PARTITION BY canon) AS keep_idx FROM c)
SELECT keep_idx, _idx AS copy_idx FROM g WHERE keep_idx <> _idx""",
    "p1_collapsed": "SELECT keep_idx, count(*) AS copies FROM (SELECT min(_idx) OVER (PARTITION BY canon) AS keep_idx FROM (SELECT _idx, coalesce(min(pairs) OVER (PARTITION BY plain), plain) AS canon FROM (SELECT _idx, p0 || chr(31) || p1 || chr(31) || p2 AS plain, CASE WHEN coalesce(s0, s1, s2) IS NOT NULL THEN coalesce(s0, p0) || chr(31) || coalesce(s1, p1) || chr(31) || coalesce(s2, p2) END AS pairs FROM (SELECT _idx, "
    + ", ".join(f"{_letters(c)} AS p{k}, {_structured(c)} AS s{k}" for k, c in enumerate(_THREE))
    + " FROM raw_instructions)))) GROUP BY keep_idx",
    "p4_report": f"""
WITH n AS (SELECT {_LETTERS.format(c="regexp_split_to_array(category, '\\s*(?:[/>:|]|\\s[-–—]+\\s|[(\\[])\\s*')[1]")} AS k FROM raw_instructions),
have AS (SELECT k, count(*) AS rows FROM n GROUP BY k), total AS (SELECT count(*) AS all_rows FROM raw_instructions),
t AS (SELECT {_LETTERS.format(c="category")} AS k, min(category) AS category, sum(coalesce(target_share, 0)) AS share, max(coalesce(min_rows, 0)) AS min_rows, max(coalesce(sample_fraction, 0)) AS f FROM sample_targets WHERE category IS NOT NULL GROUP BY 1),
r AS (SELECT category, share AS target_share, min_rows, coalesce(have.rows, 0) AS rows, share * (max(f) OVER () * total.all_rows) AS w FROM t CROSS JOIN total LEFT JOIN have USING (k)),
q AS (SELECT *, least(greatest(round_even(least(greatest(w, min_rows), rows), 0), least(min_rows, rows)), rows)::bigint AS drawn FROM r)
SELECT category, target_share, min_rows, rows, round(w, 6) AS wanted, drawn, round(drawn - w, 6) + 0.0::double AS gap, drawn < w AND drawn = rows AS unmet, drawn < min_rows AS below_minimum FROM q""",
    "p4_found": f"""
WITH n AS (SELECT {_LETTERS.format(c="regexp_split_to_array(category, '\\s*(?:[/>:|]|\\s[-–—]+\\s|[(\\[])\\s*')[1]")} AS k FROM raw_instructions),
have AS (SELECT k, count(*) AS rows FROM n GROUP BY k), total AS (SELECT count(*) AS all_rows FROM raw_instructions)
SELECT t.category FROM sample_targets t CROSS JOIN total LEFT JOIN have ON have.k = {_LETTERS.format(c="t.category")}
WHERE coalesce(have.rows, 0) < t.target_share * t.sample_fraction * total.all_rows""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Building blocks of the SQL that states each query independently of the Spark side (DuckDB dialect)."""

from __future__ import annotations

WS = r"[\t-\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WORD = r"[^\p{L}\p{N}_]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean(x: str) -> str:
    a = f"regexp_replace(coalesce({x}, ''), '\\r\\n?', chr(10), 'g')"
    b = f"regexp_replace({a}, '[ \\t]+', ' ', 'g')"
    return strip(f"regexp_replace({b}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def canonical(x: str) -> str:
    return f"regexp_replace(lower({strip(x)}), '[ \\t]+', ' ', 'g')"


def content_hash(i: str = "instruction", c: str = "context", r: str = "response") -> str:
    return f"sha256({canonical(i)} || chr(31) || {canonical(c)} || chr(31) || {canonical(r)})"


def answer(x: str) -> str:
    gone = f"translate(lower(coalesce({x}, '')), '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{{|}}~', '')"
    once = f"regexp_replace({gone}, '(^|{NOT_WORD})(?:a|an|the)($|{NOT_WORD})', '\\1 \\2', 'g')"
    twice = f"regexp_replace({once}, '(^|{NOT_WORD})(?:a|an|the)($|{NOT_WORD})', '\\1 \\2', 'g')"
    return strip(f"regexp_replace({twice}, '{WS}+', ' ', 'g')")


def answer_tokens(x: str) -> str:
    return f"list_filter(string_split({answer(x)}, ' '), lambda t: t <> '')"


def ws_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '{WS}+'), lambda t: t <> '')"


REC = f"""rec AS (SELECT _idx, coalesce(nullif(id, ''), substr(sha1('raw_instructions|' || {canonical("i")} || '|' || {canonical("r")}), 1, 12) || '-' || lpad(_idx::varchar, greatest(6, length(_idx::varchar))::int, '0')) AS id,
 i AS instruction, c AS context, r AS response, k AS category, source_name
 FROM (SELECT *, {clean("instruction")} AS i, {clean("context")} AS c, {clean("response")} AS r, {clean("category")} AS k FROM raw_instructions))"""

RULED = f"""ruled AS (SELECT *, {content_hash()} AS content_hash, CASE
 WHEN {strip("instruction")} = '' THEN 'instruction_missing'
 WHEN length(instruction) < 8 THEN 'instruction_too_short'
 WHEN length(instruction) > 4000 THEN 'instruction_too_long'
 WHEN length(response) > 4000 THEN 'response_too_long'
 WHEN length(context) > 8000 THEN 'context_too_long'
 WHEN lower({strip("instruction")}) = lower({strip("response")}) THEN 'response_echoes_instruction'
 WHEN regexp_matches(instruction || ' ' || context || ' ' || response, '[\\x00-\\x08\\x0b-\\x1f]') THEN 'contains_control_chars'
 WHEN {strip("response")} = '' THEN 'response_missing'
 WHEN length(response) < 1 THEN 'response_too_short' END AS failed FROM rec)"""

JUDGED = "judged AS (SELECT *, coalesce(failed, CASE WHEN row_number() OVER (PARTITION BY content_hash, failed IS NULL ORDER BY _idx) > 1 THEN 'duplicate' END) AS reason FROM ruled)"

SPLIT = """kept AS (SELECT * FROM judged WHERE reason IS NULL), bucketed AS (SELECT *, (('0x' || substr(sha256('v1.0:42|' || content_hash), 1, 8))::bigint % 10000)::int AS bucket FROM kept),
 split AS (SELECT *, CASE WHEN bucket < 8000 THEN 'train' WHEN bucket < 9000 THEN 'validation' ELSE 'test' END AS split FROM bucketed)"""

GOLD = "gold AS (SELECT *, 'train' AS split FROM train UNION ALL BY NAME SELECT *, 'validation' AS split FROM validation UNION ALL BY NAME SELECT *, 'test' AS split FROM test)"

PAIRS = f"""pairs AS (SELECT _idx, coalesce(source_name, '') AS run_id, response AS prediction, context AS reference, {answer_tokens("response")} AS p, {answer_tokens("context")} AS r
 FROM raw_instructions)"""

# The longest common subsequence, by the least place in r at which one of each length can end; a token moves these places
# to its own places behind the next shorter one's.
LCS = """len(list_reduce(list_prepend([]::int[], list_transform(p, lambda t: list_filter(range(1, len(r) + 1)::int[], lambda k: r[k] = t))),
  lambda b, hits: list_filter(list_transform(range(1, len(b) + 2)::int[], lambda v: least(coalesce(b[v], 2147483647),
   coalesce(list_min(list_filter(hits, lambda k: k > CASE WHEN v = 1 THEN 0 ELSE b[v - 1] END)), 2147483647))), lambda x: x < 2147483647)))::double"""

SCORED = f"""counted AS (SELECT *, {LCS} AS lcs, coalesce(list_sum(list_transform(list_distinct(p), lambda t: least(len(list_filter(p, lambda x: x = t)), len(list_filter(r, lambda x: x = t))))), 0)::double AS common FROM pairs),
 scored AS (SELECT *, (array_to_string(p, ' ') = array_to_string(r, ' '))::int::double AS exact_match,
  CASE WHEN len(p) = 0 AND len(r) = 0 THEN 1.0::double WHEN len(p) = 0 OR len(r) = 0 OR common = 0 THEN 0.0::double ELSE 2 * (common / len(p)) * (common / len(r)) / (common / len(r) + common / len(p)) END AS token_f1,
  CASE WHEN len(p) = 0 AND len(r) = 0 THEN 1.0::double WHEN len(p) = 0 OR len(r) = 0 OR lcs = 0 THEN 0.0::double ELSE 2.44 * (lcs / len(p)) * (lcs / len(r)) / (lcs / len(r) + 1.44 * (lcs / len(p))) END AS rouge_l,
  CASE WHEN len(r) = 0 THEN 0.0::double ELSE len(p)::double / len(r) END AS length_ratio FROM counted)"""

_FIN = "CASE WHEN isfinite({0}) THEN {0} ELSE 0.0::double END AS {0}"
CAND = f"""cand AS (SELECT run_id, run_name, lower(method) AS method, quality, {_FIN.format("latency_ms")}, {_FIN.format("memory_mb")}, {_FIN.format("model_size_mb")}, {_FIN.format("cost_per_1k_usd")},
 coalesce(is_baseline, false) AS is_baseline, _idx, dataset_version FROM candidates WHERE isfinite(quality))"""

_AXES = (("quality", "quality", 0.55, True), ("latency", "latency_ms", 0.20, False), ("memory", "memory_mb", 0.15, False), ("model_size", "model_size_mb", 0.05, False), ("cost", "cost_per_1k_usd", 0.05, False))


def _norm(col: str, more: bool) -> str:
    lo, hi = f"min({col}) OVER ()", f"max({col}) OVER ()"
    up = f"({col} - {lo})" if more else f"({hi} - {col})"
    return f"CASE WHEN {hi} - {lo} < 1e-12 THEN 1.0::double ELSE {up} / ({hi} - {lo}) END"


NORMED = "normed AS (SELECT *, " + ", ".join(f"{_norm(col, more)} AS n_{axis}" for axis, col, _, more in _AXES) + " FROM cand)"
UTIL = "util AS (SELECT *, " + " + ".join(f"({w}::double / (0.55::double + 0.2::double + 0.15::double + 0.05::double + 0.05::double)) * n_{axis}" for axis, _, w, _ in _AXES) + " AS utility FROM normed)"
GATED = """base AS (SELECT * FROM cand WHERE is_baseline ORDER BY _idx LIMIT 1),
 gated AS (SELECT u.*, CASE WHEN u.is_baseline THEN 'is_baseline' WHEN b.quality > 0 AND u.quality / b.quality < 0.9::double THEN 'quality_ratio' WHEN b.quality > 0 AND u.quality <= b.quality THEN 'not_above_baseline' END AS reason
  FROM util u LEFT JOIN base b ON true),
 ranking AS (SELECT _idx, row_number() OVER (ORDER BY round(utility, 6) DESC, latency_ms, _idx) AS rank FROM gated WHERE reason IS NULL)"""
FRONT = """front AS (SELECT * FROM cand a WHERE NOT is_baseline AND NOT EXISTS (SELECT 1 FROM cand b WHERE NOT b.is_baseline
 AND b.quality >= a.quality AND b.latency_ms <= a.latency_ms AND b.memory_mb <= a.memory_mb AND b.model_size_mb <= a.model_size_mb AND b.cost_per_1k_usd <= a.cost_per_1k_usd
 AND (b.quality > a.quality OR b.latency_ms < a.latency_ms OR b.memory_mb < a.memory_mb OR b.model_size_mb < a.model_size_mb OR b.cost_per_1k_usd < a.cost_per_1k_usd)))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n ".join(ctes) + "\n"


def pick(value: str, q: float, mode: str) -> str:
    """Sorted position by floor or round-half-even rank, 0.0 without values."""
    rank = f"{'floor' if mode == 'floor' else 'round_even'}({q}::double * (count({value}) - 1){'' if mode == 'floor' else ', 0'})"
    return f"list_sort(list({value}) FILTER (WHERE {value} IS NOT NULL))[({rank})::int + 1]::double"

"""Every registered query of the core, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import serving
from lodestone.config import ModelConfig, SelectionConfig
from lodestone.functions import numeric as N
from lodestone.functions import text as T
from lodestone.operators import evaluation, prompts, quality, records, runs, selection, stats
from lodestone.plans import sql as S
from lodestone.session import new_path
from lodestone.sources import files
from lodestone.streaming import requests

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _records(spark, d) -> DataFrame:
    return records.normalize(_t(spark, d, "raw_instructions"), "raw_instructions")


def _judged(spark, d, *keep: str) -> DataFrame:
    """Ordinal, hash and reason of every record, and the columns to keep."""
    return records.judged(_records(spark, d), keep=keep)


def _kept(spark, d, *keep: str) -> DataFrame:
    return records.kept(_records(spark, d), keep=keep)


def _split(spark, d, *keep: str) -> DataFrame:
    return records.assign_split(_kept(spark, d, *keep))


def _gold(spark, d) -> DataFrame:
    parts = [_t(spark, d, n).withColumn("split", F.lit(n)) for n in ("train", "validation", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Records


@_query(f"SELECT _idx, {S.clean('instruction')} AS instruction, {S.clean('context')} AS context, {S.clean('response')} AS response FROM raw_instructions")
def clean_text(spark, d):
    return _t(spark, d, "raw_instructions").select("_idx", *[T.clean_text(F.col(c)).alias(c) for c in ("instruction", "context", "response")])


@_query(S.with_(S.REC) + "SELECT _idx, id, instruction, context, response, category, source_name AS meta_source FROM rec")
def normalize_records(spark, d):
    return _records(spark, d).select("_idx", "id", "instruction", "context", "response", "category", F.get_json_object("meta", "$.source_name").alias("meta_source"))


@_query(
    f"SELECT log_id AS _idx, substr(sha1('log|' || {S.canonical(S.clean('prompt'))} || '|' || {S.canonical(S.clean('prediction'))}), 1, 12) || '-' || lpad(log_id::varchar, greatest(6, length(log_id::varchar))::int, '0') AS id, "
    f"{S.clean('prompt')} AS instruction, {S.clean('context')} AS context, {S.clean('prediction')} AS response, '' AS category, model AS meta_model FROM predict_log"
)
def normalize_aliases(spark, d):
    log = _t(spark, d, "predict_log").select("log_id", "prompt", "context", F.col("prediction").alias("output"), "model")
    return records.normalize(log, "log", "log_id").select("_idx", "id", "instruction", "context", "response", "category", F.get_json_object("meta", "$.model").alias("meta_model"))


@_query(S.with_(S.REC) + "SELECT _idx, id, instruction, category FROM rec WHERE _idx < 500")
def head_limit(spark, d):
    return records.normalize(records.head(_t(spark, d, "raw_instructions"), 500), "raw_instructions").select("_idx", "id", "instruction", "category")


@_query(S.with_(S.REC) + f"SELECT _idx, {S.content_hash()} AS content_hash FROM rec")
def content_hash(spark, d):
    return records.with_hash(_records(spark, d)).select("_idx", "content_hash")


@_query(f"SELECT _idx, length({S.clean('instruction')}) + length({S.clean('context')}) + length({S.clean('response')}) AS total_chars FROM raw_instructions")
def total_chars(spark, d):
    r = _records(spark, d)
    return r.select("_idx", (F.length("instruction") + F.length("context") + F.length("response")).cast("bigint").alias("total_chars"))


# Validation


@_query(S.with_(S.REC, S.RULED) + "SELECT _idx, failed FROM ruled WHERE failed IS NOT NULL")
def validation_rules(spark, d):
    return _records(spark, d).select("_idx", records.failed_rule().alias("failed")).where("failed is not null")


@_query(S.with_(S.REC, S.RULED, S.JUDGED) + "SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason")
def validation_report(spark, d):
    return records.drop_counts(_judged(spark, d))


@_query(
    S.with_(S.REC, S.RULED, S.JUDGED)
    + "SELECT count(*) AS input, count(*) FILTER (WHERE reason IS NULL) AS kept, count(*) FILTER (WHERE reason IS NOT NULL) AS dropped, round(count(*) FILTER (WHERE reason IS NULL) / count(*)::double, 6) AS keep_rate, count(*) FILTER (WHERE reason IS NULL) / count(*)::double >= 0.7 AND count(*) FILTER (WHERE reason IS NULL) > 0 AS is_healthy FROM judged"
)
def validation_summary(spark, d):
    return records.validation_summary(_judged(spark, d))


@_query(S.with_(S.REC, S.RULED, S.JUDGED) + "SELECT _idx, id, reason, substr(instruction, 1, 160) AS instruction FROM judged WHERE reason IS NOT NULL AND reason <> 'duplicate' ORDER BY _idx LIMIT 20")
def dropped_examples(spark, d):
    return records.dropped_examples(_judged(spark, d, "id", "instruction"))


@_query(S.with_(S.REC, S.RULED, S.JUDGED) + "SELECT _idx, content_hash FROM judged WHERE reason IS NULL")
def dedupe_first(spark, d):
    return _kept(spark, d).select("_idx", "content_hash")


@_query(S.with_(S.REC, S.RULED, S.JUDGED) + "SELECT coalesce(nullif(category, ''), 'uncategorized') AS category, count(*) AS n FROM judged WHERE reason IS NULL GROUP BY 1")
def category_counts(spark, d):
    return records.category_counts(_kept(spark, d, "category"))


@_query(S.with_(S.REC) + "SELECT id, count(*) AS n FROM rec GROUP BY id HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return records.duplicate_ids(_records(spark, d))


# Splits and fingerprints


@_query(S.with_(S.REC, S.RULED, S.JUDGED, S.SPLIT) + "SELECT _idx, bucket, split FROM split")
def hash_split(spark, d):
    return _split(spark, d).select("_idx", "bucket", "split")


@_query(S.with_(S.REC, S.RULED, S.JUDGED, S.SPLIT) + "SELECT s.split, count(split.split) AS n FROM (VALUES ('train'), ('validation'), ('test')) s(split) LEFT JOIN split USING (split) GROUP BY s.split")
def split_sizes(spark, d):
    return records.split_sizes(_split(spark, d))


@_query(S.with_(S.REC, S.RULED, S.JUDGED, S.SPLIT) + "SELECT split, category, count(*) AS n FROM split GROUP BY split, category")
def category_distribution(spark, d):
    return _split(spark, d, "category").groupBy("split", "category").agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT content_hash FROM train INTERSECT (SELECT content_hash FROM validation UNION ALL SELECT content_hash FROM test)")
def split_leakage(spark, d):
    return records.leaked(_gold(spark, d))


@_query(S.with_(S.REC, S.RULED, S.JUDGED) + "SELECT sha256(coalesce(string_agg(content_hash, '' ORDER BY content_hash), '')) AS content_hash, count(*) AS num_examples FROM judged WHERE reason IS NULL")
def fingerprint(spark, d):
    return records.fingerprint(_kept(spark, d))


@_query(
    S.with_(S.GOLD)
    + "SELECT split, concat_ws(',', "
    + ", ".join(f"sum(('0x' || substr(content_hash, {4 * k + 1}, 4))::bigint)::bigint::varchar" for k in range(records.LIMBS))
    + ") AS limbs, count(*) AS num_examples FROM gold GROUP BY split"
)
def mergeable_fingerprints(spark, d):
    return records.limb_sums(_gold(spark, d), ("split",))


@_query(S.with_(S.GOLD) + "SELECT split, sha256(string_agg(content_hash, '' ORDER BY content_hash)) AS content_hash, count(*) AS num_examples FROM gold GROUP BY split")
def split_fingerprints(spark, d):
    return records.split_fingerprints(_gold(spark, d))


@_query(S.with_(S.GOLD) + "SELECT sha256(string_agg(content_hash, '' ORDER BY content_hash)) AS content_hash, count(*) AS num_examples FROM gold")
def union_refingerprint(spark, d):
    return records.fingerprint(_gold(spark, d))


@_query(
    S.with_(S.REC, S.RULED, S.JUDGED)
    + f"""SELECT round(avg(i), 2) AS instruction_chars_mean, round(avg(r), 2) AS response_chars_mean, max(t)::double AS total_chars_max, round(avg(c) * 100, 2) AS pct_with_context,
 {S.pick("i", 0.95, "floor")} AS instruction_chars_p95, {S.pick("r", 0.95, "floor")} AS response_chars_p95, {S.pick("t", 0.95, "floor")} AS total_chars_p95
 FROM (SELECT length(instruction) AS i, length(response) AS r, length(instruction) + length(context) + length(response) AS t, (context <> '')::int AS c FROM judged WHERE reason IS NULL)"""
)
def length_stats(spark, d):
    return records.length_stats(records.kept(records.with_lengths(_records(spark, d)), keep=records.LENGTHS))


@_query("SELECT id, instruction, coalesce(context, '') AS context, response, coalesce(category, '') AS category FROM test")
def gold_records(spark, d):
    return records.gold_records(_t(spark, d, "test"))


@_query("SELECT _idx, instruction FROM raw_instructions ORDER BY sha256('42|' || _idx), _idx LIMIT 100")
def seeded_sample(spark, d):
    return records.sampled(_t(spark, d, "raw_instructions").select("_idx", "instruction"), 100, 42, "_idx")


# Prompts and tokens

_I, _C, _R = S.strip("coalesce(instruction, '')"), S.strip("coalesce(context, '')"), S.strip("coalesce(response, '')")
_PLAIN = f"'### Instruction:' || chr(10) || {_I} || chr(10) || chr(10) || CASE WHEN {_C} <> '' THEN '### Context:' || chr(10) || {_C} || chr(10) || chr(10) ELSE '' END || '### Response:' || chr(10)"


@_query(f"SELECT _idx, CASE WHEN {_C} <> '' THEN {_I} || chr(10) || chr(10) || 'Context:' || chr(10) || {_C} ELSE {_I} END AS message FROM raw_instructions")
def user_message(spark, d):
    return _t(spark, d, "raw_instructions").select("_idx", prompts.user_message(F.col("instruction"), F.col("context")).alias("message"))


@_query(f"SELECT _idx, {_PLAIN} AS prompt, {_R} AS reference FROM raw_instructions")
def plain_prompt(spark, d):
    return _t(spark, d, "raw_instructions").select("_idx", prompts.plain_prompt(F.col("instruction"), F.col("context")).alias("prompt"), T.strip(T.text(F.col("response"))).alias("reference"))


@_query(f"SELECT _idx, {_PLAIN} || {_R} || '</s>' AS example FROM raw_instructions")
def training_example(spark, d):
    return _t(spark, d, "raw_instructions").select("_idx", prompts.training_example(F.col("instruction"), F.col("context"), F.col("response"), "</s>").alias("example"))


@_query(f"SELECT _idx, 2 AS turns, 'system,user' AS roles, CASE WHEN {_C} <> '' THEN {_I} || chr(10) || chr(10) || 'Context:' || chr(10) || {_C} ELSE {_I} END AS last_turn FROM raw_instructions")
def chat_messages(spark, d):
    m = _t(spark, d, "raw_instructions").select("_idx", prompts.chat_messages(F.col("instruction"), F.col("context")).alias("m"))
    return m.select("_idx", F.size("m").alias("turns"), F.array_join("m.role", ",").alias("roles"), F.element_at("m", -1)["content"].alias("last_turn"))


_IDS = f"""ids AS (SELECT _idx, list_transform({S.ws_tokens("instruction")}, lambda t: length(t)) AS p, list_transform({S.ws_tokens("response")}, lambda t: length(t)) AS a FROM raw_instructions),
 rows AS (SELECT _idx, list_concat(p, a) AS x, list_concat(list_transform(p, lambda t: -100), a) AS y FROM ids),
 cut AS (SELECT _idx, CASE WHEN len(x) > {ModelConfig().max_seq_length} THEN x[-{ModelConfig().max_seq_length}:] ELSE x END AS x, CASE WHEN len(y) > {ModelConfig().max_seq_length} THEN y[-{ModelConfig().max_seq_length}:] ELSE y END AS y FROM rows)"""


def _supervised(spark, d) -> DataFrame:
    raw = _t(spark, d, "raw_instructions")
    size = lambda c: F.transform(T.whitespace_tokens(F.col(c)), lambda t: F.length(t))
    ids, labels = prompts.supervised(size("instruction"), size("response"), ModelConfig().max_seq_length)
    return raw.select("_idx", ids.alias("input_ids"), labels.alias("labels"))


@_query(S.with_(_IDS) + "SELECT _idx, array_to_string(x, ' ') AS input_ids, array_to_string(y, ' ') AS labels, len(list_filter(y, lambda t: t <> -100)) AS supervised FROM cut WHERE len(list_filter(y, lambda t: t <> -100)) > 0")
def token_mask(spark, d):
    s = _supervised(spark, d).withColumn("supervised", prompts.supervised_count(F.col("labels")).cast("bigint")).where("supervised > 0")
    return s.select("_idx", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"), F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"), "supervised")


@_query(
    S.with_(_IDS, "b AS (SELECT *, _idx // 8 AS batch_id FROM cut)", "w AS (SELECT *, (ceil(max(len(x)) OVER (PARTITION BY batch_id) / 8.0) * 8)::int AS width FROM b)")
    + "SELECT _idx, batch_id, width, array_to_string(list_concat(x, list_transform(range(width - len(x)), lambda t: 0)), ' ') AS input_ids, array_to_string(list_concat(y, list_transform(range(width - len(x)), lambda t: -100)), ' ') AS labels, len(x) AS ones FROM w"
)
def token_pad(spark, d):
    p = prompts.padded(_supervised(spark, d).withColumn("batch_id", F.floor(F.col("_idx") / 8).cast("bigint")), "batch_id")
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), " ").alias(c)
    return p.select("_idx", "batch_id", F.size("input_ids").alias("width"), text("input_ids"), text("labels"), F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("ones"))


@_query(
    S.with_(_IDS)
    + f"SELECT round(avg(n), 4) AS mean_tokens, {S.pick('n', 0.95, 'floor')} AS p95_tokens, max(n)::double AS max_tokens, round(sum(s) / sum(n)::double * 100, 4) AS supervised_pct FROM (SELECT len(x) AS n, len(list_filter(y, lambda t: t <> -100)) AS s FROM cut)"
)
def corpus_token_stats(spark, d):
    t = _supervised(spark, d).select(F.size("input_ids").alias("n"), prompts.supervised_count(F.col("labels")).alias("s"))
    base = t.agg(F.round(F.avg("n"), 4).alias("mean_tokens"), F.max("n").cast("double").alias("max_tokens"), F.round(N.ratio(F.sum("s"), F.sum("n")) * 100, 4).alias("supervised_pct"))
    return base.crossJoin(F.broadcast(stats.rank_pick(t, [], "n", {"p95_tokens": 0.95}, "floor")))


@_query("SELECT log_id, '[stub] No model is loaded, so this is a placeholder response. The prompt received was: ' || substr(prompt, 1, 200) AS text, 'stub' AS finish_reason FROM predict_log")
def stub_prediction(spark, d):
    return _t(spark, d, "predict_log").select("log_id", prompts.stub_prediction(F.col("prompt")).alias("text"), F.lit("stub").alias("finish_reason"))


@_query("SELECT log_id, CASE WHEN completion_tokens >= max_new_tokens THEN 'length' ELSE 'stop' END AS finish_reason FROM predict_log")
def finish_reason(spark, d):
    return _t(spark, d, "predict_log").select("log_id", prompts.finish_reason(F.col("completion_tokens"), F.col("max_new_tokens")).alias("finish_reason"))


@_query(f"SELECT log_id, len({S.ws_tokens('prompt')}) AS prompt_words, len({S.ws_tokens('prediction')}) AS prediction_words FROM predict_log")
def whitespace_counts(spark, d):
    n = lambda c: F.size(T.whitespace_tokens(F.col(c))).cast("bigint")
    return _t(spark, d, "predict_log").select("log_id", n("prompt").alias("prompt_words"), n("prediction").alias("prediction_words"))


# Quality


def _pairs(spark, d) -> DataFrame:
    return _t(spark, d, "raw_instructions").select("_idx", F.coalesce("source_name", F.lit("")).alias("run_id"), F.col("response").alias("prediction"), F.col("context").alias("reference"))


@_query(f"SELECT _idx, {S.answer('response')} AS answer FROM raw_instructions")
def normalize_answer(spark, d):
    return _t(spark, d, "raw_instructions").select("_idx", T.normalize_answer(F.col("response")).alias("answer"))


@_query(f"SELECT _idx, len({S.answer_tokens('response')}) AS n, array_to_string({S.answer_tokens('response')}, '|') AS tokens FROM raw_instructions")
def answer_tokens(spark, d):
    t = T.answer_tokens(F.col("response"))
    return _t(spark, d, "raw_instructions").select("_idx", F.size(t).cast("bigint").alias("n"), F.array_join(t, "|").alias("tokens"))


@_query(S.with_(S.PAIRS, S.SCORED) + "SELECT _idx, run_id, exact_match, round(token_f1, 6) AS token_f1, round(length_ratio, 6) AS length_ratio FROM scored")
def quality_scores(spark, d):
    s = quality.scored(_pairs(spark, d))
    return s.select("_idx", "run_id", "exact_match", F.round("token_f1", 6).alias("token_f1"), F.round("length_ratio", 6).alias("length_ratio"))


@_query(S.with_(S.PAIRS, S.SCORED) + "SELECT _idx, round(rouge_l, 6) AS rouge_l FROM scored")
def rouge_l(spark, d):
    return quality.scored(_pairs(spark, d)).select("_idx", F.round("rouge_l", 6).alias("rouge_l"))


@_query(S.with_(S.PAIRS, S.SCORED) + "SELECT run_id, round(avg(exact_match), 6) AS exact_match, round(avg(token_f1), 6) AS token_f1, round(avg(rouge_l), 6) AS rouge_l, round(avg(length_ratio), 6) AS length_ratio, count(*) AS n FROM scored GROUP BY run_id")
def quality_macro(spark, d):
    m = quality.macro_means(quality.scored(_pairs(spark, d)), ("exact_match", "token_f1", "rouge_l"), ("run_id",))
    return m.select("run_id", *[F.round(c, 6).alias(c) for c in ("exact_match", "token_f1", "rouge_l", "length_ratio")], "n")


@_query(
    S.with_(S.PAIRS, S.SCORED)
    + """, placed AS (SELECT run_id, _idx, token_f1, row_number() OVER (PARTITION BY run_id ORDER BY token_f1, _idx) AS lo, row_number() OVER (PARTITION BY run_id ORDER BY token_f1 DESC, _idx DESC) AS hi FROM scored)
 SELECT run_id, _idx, round(token_f1, 6) AS token_f1, 'worst' AS bucket FROM placed WHERE lo <= 10 UNION ALL SELECT run_id, _idx, round(token_f1, 6) AS token_f1, 'best' AS bucket FROM placed WHERE hi <= 5"""
)
def best_worst_samples(spark, d):
    b = quality.best_and_worst(quality.scored(_pairs(spark, d)).select("run_id", "_idx", "token_f1"), "run_id", "token_f1")
    return b.select("run_id", "_idx", F.round("token_f1", 6).alias("token_f1"), "bucket")


@_query(
    S.with_(S.PAIRS, S.SCORED)
    + """, placed AS (SELECT run_id, _idx, rouge_l, prediction, reference, row_number() OVER (PARTITION BY run_id ORDER BY rouge_l, _idx) AS lo, row_number() OVER (PARTITION BY run_id ORDER BY rouge_l DESC, _idx DESC) AS hi FROM scored),
 chosen AS (SELECT *, 'worst' AS bucket FROM placed WHERE lo <= 10 UNION ALL SELECT *, 'best' AS bucket FROM placed WHERE hi <= 5)
 SELECT _idx, run_id, round(c.rouge_l, 6) AS rouge_l, bucket, substr(i.instruction, 1, 400) AS instruction, substr(c.reference, 1, 400) AS reference, substr(c.prediction, 1, 400) AS prediction FROM chosen c JOIN raw_instructions i USING (_idx)"""
)
def sample_texts(spark, d):
    scores = quality.scored(_pairs(spark, d)).select("run_id", "_idx", "rouge_l")
    chosen = quality.best_and_worst(scores, "run_id", "rouge_l").withColumn("rouge_l", F.round("rouge_l", 6))
    texts = _t(spark, d, "raw_instructions").select("_idx", "instruction", F.col("context").alias("reference"), F.col("response").alias("prediction"))
    return quality.with_texts(chosen, texts)


# Latency, cost, memory, perplexity


@_query(
    f"""SELECT model, count(*) AS n, round(avg(latency_ms), 9) AS mean_ms, round(quantile_cont(latency_ms, 0.5), 6) AS median_ms, round({S.pick("latency_ms", 0.95, "round")}, 6) AS p95_ms, round({S.pick("latency_ms", 0.99, "round")}, 6) AS p99_ms,
 min(latency_ms) AS min_ms, max(latency_ms) AS max_ms, round(coalesce(stddev_samp(latency_ms), 0), 4) AS std_ms, round(avg(completion_tokens) / (avg(latency_ms) / 1000), 4) AS tokens_per_second FROM predict_log WHERE latency_ms IS NOT NULL GROUP BY model"""
)
def latency_summary(spark, d):
    s = stats.latency_summary(_t(spark, d, "predict_log"), ["model"], "latency_ms", "completion_tokens")
    r6 = [F.round(c, 9 if c == "mean_ms" else 6).alias(c) for c in ("mean_ms", "median_ms", "p95_ms", "p99_ms")]
    return s.select("model", "n", *r6, "min_ms", "max_ms", F.round("std_ms", 4).alias("std_ms"), F.round("tokens_per_second", 4).alias("tokens_per_second"))


@_query(
    "WITH m AS (SELECT client, max_new_tokens, coalesce(finish_reason = 'error', false) AS oom, latency_ms, log_id FROM predict_log), f AS (SELECT client, min(max_new_tokens) AS first FROM m WHERE oom GROUP BY client) SELECT m.client, m.log_id, m.max_new_tokens FROM m LEFT JOIN f USING (client) WHERE f.first IS NULL OR m.max_new_tokens < f.first"
)
def throughput_curve(spark, d):
    m = _t(spark, d, "predict_log").select("client", "log_id", "max_new_tokens", F.coalesce(F.col("finish_reason") == "error", F.lit(False)).alias("oom"))
    return stats.throughput_curve(m, ["client"], "max_new_tokens", "oom").select("client", "log_id", "max_new_tokens")


@_query(
    "WITH r AS (SELECT log_id, CASE WHEN latency_ms > 0 THEN 3600.0::double / (latency_ms / 1000.0::double) ELSE 0.0::double END AS rph FROM predict_log) SELECT log_id, round(rph, 6) AS requests_per_hour, CASE WHEN rph > 0 THEN round(0.6::double / rph * 1000.0::double, 9) ELSE 'inf'::double END AS cost_per_1k FROM r"
)
def cost_model(spark, d):
    p = _t(spark, d, "predict_log").select("log_id", N.requests_per_hour(F.col("latency_ms"), F.lit(1)).alias("rph"))
    c = N.cost_per_1k(F.lit(0.6), F.col("rph"))
    return p.select("log_id", F.round("rph", 6).alias("requests_per_hour"), F.when(F.col("rph") > 0, F.round(c, 9)).otherwise(c).alias("cost_per_1k"))


@_query("SELECT log_id, CASE WHEN completion_tokens > 0 AND latency_ms > 0 THEN round(0.6::double / ((completion_tokens / (latency_ms / 1000.0::double)) * 3600.0::double) * 1e6::double, 4) ELSE 'inf'::double END AS cost_per_1m_tokens FROM predict_log")
def token_cost(spark, d):
    tps = F.when(F.col("latency_ms") > 0, F.col("completion_tokens") / (F.col("latency_ms") / 1000.0)).otherwise(F.lit(0.0))
    c = N.cost_per_1m_tokens(F.lit(0.6), F.coalesce(tps, F.lit(0.0)))
    return _t(spark, d, "predict_log").select("log_id", F.when(c == N.INF, c).otherwise(F.round(c, 4)).alias("cost_per_1m_tokens"))


@_query(
    "SELECT run_id, round(greatest(memory_mb - model_size_mb, 0.0::double), 6) AS overhead_mb, round(CASE WHEN 16384.0 > 0 THEN memory_mb / 16384.0::double * 100 ELSE 0 END, 6) AS utilization_pct, round(CASE WHEN memory_mb > 0 THEN model_size_mb / memory_mb * 100 ELSE 0.0::double END, 6) AS weights_pct FROM candidates"
)
def memory_derived(spark, d):
    c = _t(spark, d, "candidates")
    m, w = F.col("memory_mb"), F.col("model_size_mb")
    return c.select("run_id", F.round(N.activation_overhead_mb(m, w), 6).alias("overhead_mb"), F.round(N.utilization_pct(m, F.lit(16384.0)), 6).alias("utilization_pct"), F.round(N.trainable_pct(w, m), 6).alias("weights_pct"))


@_query("SELECT model, round(sum(latency_ms) / 1000.0::double / 3600.0::double * 0.6::double, 9) AS cost_usd FROM predict_log GROUP BY model")
def training_cost(spark, d):
    g = _t(spark, d, "predict_log").groupBy("model").agg(F.sum("latency_ms").alias("ms"))
    return g.select("model", F.round(N.training_cost(F.col("ms") / 1000.0, F.lit(0.6)), 9).alias("cost_usd"))


_STEPS = "CASE WHEN _idx % 3 = 0 AND _idx > 0 THEN _idx ELSE greatest(1, ceil(ceil((_idx * 37 + 1) / 16.0::double) * 2.5::double)::bigint) END"


@_query(
    f"SELECT run_id, ({_STEPS})::bigint AS steps, round({_STEPS} * 10.0::double * greatest((16.0 / 16.0) * (512.0 / 1024.0) * CASE WHEN is_baseline THEN 1.0 ELSE 0.75 END, 0.05)::double, 6) AS minutes, round_even(0.03::double * {_STEPS}, 0)::bigint AS warmup FROM candidates"
)
def optimizer_steps(spark, d):
    c = _t(spark, d, "candidates").withColumn("max_steps", F.when(F.col("_idx") % 3 == 0, F.col("_idx")).otherwise(F.lit(-1)))
    c = c.withColumn("steps", N.optimizer_steps(F.col("_idx") * 37 + 1, F.lit(16), F.lit(2.5), F.col("max_steps")))
    return c.select("run_id", "steps", F.round(N.cpu_minutes(F.col("steps"), F.lit(16), F.lit(512), F.col("is_baseline")), 6).alias("minutes"), N.warmup_steps(F.lit(0.03), F.col("steps")).alias("warmup"))


@_query("SELECT l_returnflag, sum(l_quantity) AS tokens, round(sum(l_tax * l_quantity) / sum(l_quantity), 9) AS mean_loss, round(exp(least(sum(l_tax * l_quantity) / sum(l_quantity), 20.0::double)), 9) AS perplexity FROM lineitem GROUP BY l_returnflag")
def perplexity(spark, d):
    p = stats.perplexity(_t(spark, d, "lineitem"), ["l_returnflag"], "l_tax", "l_quantity")
    return p.select("l_returnflag", "tokens", F.round("mean_loss", 9).alias("mean_loss"), F.round("perplexity", 9).alias("perplexity"))


@_query("SELECT model, log_id, latency_ms, max(latency_ms) OVER (PARTITION BY model ORDER BY log_id ROWS UNBOUNDED PRECEDING) AS peak FROM predict_log")
def running_peak(spark, d):
    return stats.running_peak(_t(spark, d, "predict_log"), ["model"], "log_id", "latency_ms")


@_query("SELECT model, arg_max(latency_ms, log_id) AS last FROM predict_log WHERE latency_ms IS NOT NULL GROUP BY model")
def last_value(spark, d):
    return stats.last_value(_t(spark, d, "predict_log"), ["model"], "log_id", "latency_ms")


_TENSORS = """t AS (SELECT l_suppkey AS model, l_quantity::bigint * 1000 AS numel, l_linenumber AS element_size, CASE WHEN l_returnflag = 'R' THEN 'Params4bit' ELSE 'Parameter' END AS kind, l_linestatus = 'O' AS trainable, l_linenumber = 7 AS buffer FROM lineitem),
 h AS (SELECT *, CASE WHEN buffer THEN 0 WHEN kind = 'Params4bit' THEN 2 * numel ELSE numel END AS held FROM t)"""


@_query(
    S.with_(_TENSORS)
    + """SELECT model, sum(held)::bigint AS params_total, sum(CASE WHEN trainable THEN held ELSE 0 END)::bigint AS params_trainable, sum(CASE WHEN trainable THEN 0 ELSE held END)::bigint AS params_frozen, sum(numel * element_size)::bigint AS bytes,
 round(CASE WHEN sum(held) > 0 THEN sum(CASE WHEN trainable THEN held ELSE 0 END)::double / sum(held)::double * 100 ELSE 0 END, 6) AS params_trainable_pct, round(sum(numel * element_size)::double / 1048576, 6) AS size_mb FROM h GROUP BY model"""
)
def parameter_totals(spark, d):
    """Items of a supplier as the weight tensors of a model."""
    kind = F.when(F.col("l_returnflag") == "R", stats.PACKED).otherwise("Parameter")
    t = _t(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("model"), (F.col("l_quantity").cast("bigint") * 1000).alias("numel"), F.col("l_linenumber").alias("element_size"), kind.alias("kind"), (F.col("l_linestatus") == "O").alias("trainable"), (F.col("l_linenumber") == 7).alias("buffer")
    )
    return stats.parameter_totals(t, ["model"]).withColumns({c: F.round(c, 6) for c in ("params_trainable_pct", "size_mb")})


_REPORT = f"""pairs AS (SELECT run_id, log_id, prediction, context AS reference, {S.answer_tokens("prediction")} AS p, {S.answer_tokens("context")} AS r FROM predict_log WHERE run_id IS NOT NULL),
 {S.SCORED},
 q AS (SELECT run_id, avg(rouge_l) AS rouge_l, avg(token_f1) AS token_f1, avg(exact_match) AS exact_match, avg(length_ratio) AS length_ratio, count(*) AS num_eval_examples FROM scored GROUP BY run_id),
 lat AS (SELECT run_id, avg(latency_ms) AS mean_ms, {S.pick("latency_ms", 0.95, "round")} AS p95_ms, 0.6::double / (3600.0::double / (avg(latency_ms) / 1000.0::double)) * 1000.0::double AS cost_per_1k_usd FROM predict_log WHERE latency_ms IS NOT NULL GROUP BY run_id),
 ppl AS (SELECT run_id, CASE WHEN coalesce(sum(completion_tokens), 0) > 0 THEN exp(least(sum(latency_ms / 1000.0::double * completion_tokens) / sum(completion_tokens), 20.0::double)) ELSE 'inf'::double END AS perplexity FROM predict_log WHERE run_id IS NOT NULL GROUP BY run_id),
 mem AS (SELECT run_id, memory_mb AS peak_memory_mb, model_size_mb, greatest(memory_mb - model_size_mb, 0.0::double) AS activation_overhead_mb, memory_mb / 16384.0::double * 100 AS utilization_pct FROM candidates),
 rep AS (SELECT run_id, round(rouge_l, 6) AS rouge_l, round(token_f1, 6) AS token_f1, round(exact_match, 6) AS exact_match, round(length_ratio, 6) AS length_ratio, num_eval_examples, round(mean_ms, 6) AS mean_ms, round(p95_ms, 6) AS p95_ms, round(cost_per_1k_usd, 9) AS cost_per_1k_usd,
  round(perplexity, 6) AS perplexity, round(peak_memory_mb, 6) AS peak_memory_mb, round(model_size_mb, 6) AS model_size_mb, round(activation_overhead_mb, 6) AS activation_overhead_mb, round(utilization_pct, 6) AS utilization_pct
  FROM q LEFT JOIN lat USING (run_id) LEFT JOIN ppl USING (run_id) LEFT JOIN mem USING (run_id))"""


def _report(spark, d) -> DataFrame:
    """All parts of a run: scores of its answers against their contexts, latency, cost, memory; seconds stand in for losses."""
    log = _t(spark, d, "predict_log").where("run_id is not null")
    q = evaluation.quality_by_run(log.select("run_id", F.col("log_id").alias("_idx"), "prediction", F.col("context").alias("reference")), "run_id", ("rouge_l", "token_f1", "exact_match"))
    lat = evaluation.latency_and_cost(log, "run_id", "latency_ms", "completion_tokens").select("run_id", "mean_ms", "p95_ms", "cost_per_1k_usd")
    loss = log.withColumn("loss", F.col("latency_ms") / 1000.0)
    ppl = stats.perplexity(loss, ["run_id"], "loss", "completion_tokens").select("run_id", "perplexity")
    mem = evaluation.memory_parts(_t(spark, d, "candidates"), "run_id", "memory_mb", "model_size_mb", 16384.0)
    r = evaluation.report("run_id", q, lat, ppl, mem)
    return r.withColumns({c: F.round(c, 9 if c == "cost_per_1k_usd" else 6) for c, t in r.dtypes if t == "double"})


@_query(S.with_(_REPORT) + "SELECT * FROM rep")
def evaluation_report(spark, d):
    return _report(spark, d)


@_query(
    S.with_(_REPORT)
    + "SELECT run_id, key, value FROM (UNPIVOT (SELECT * REPLACE (num_eval_examples::double AS num_eval_examples) FROM rep) ON rouge_l, token_f1, exact_match, length_ratio, num_eval_examples, mean_ms, p95_ms, cost_per_1k_usd, perplexity, peak_memory_mb, model_size_mb, activation_overhead_mb, utilization_pct INTO NAME key VALUE value)"
)
def report_metrics(spark, d):
    return evaluation.as_metrics(_report(spark, d), "run_id")


@_query(S.with_(_REPORT) + "SELECT run_id, coalesce(rouge_l, 0) AS quality, coalesce(p95_ms, 0) AS latency_ms, coalesce(peak_memory_mb, 0) AS memory_mb, coalesce(model_size_mb, 0) AS model_size_mb, coalesce(cost_per_1k_usd, 0) AS cost_per_1k_usd FROM rep")
def candidates_from_report(spark, d):
    return evaluation.candidates_from_report(_report(spark, d), "run_id")


_INVALID = """CASE WHEN prompt IS NULL OR length(prompt) < 1 OR length(prompt) > 8000 THEN 'prompt' WHEN coalesce(length(context), 0) > 16000 THEN 'context' WHEN coalesce(max_new_tokens, 256) < 1 OR coalesce(max_new_tokens, 256) > 1024 THEN 'max_new_tokens'
 WHEN coalesce(temperature, 0) < 0 OR coalesce(temperature, 0) > 2 THEN 'temperature' WHEN coalesce(top_p, 0.9) <= 0 OR coalesce(top_p, 0.9) > 1 THEN 'top_p' END"""


@_query(f"SELECT log_id, {_INVALID} AS invalid FROM predict_log")
def request_validation(spark, d):
    numbers = {c: F.col(c) for c in ("max_new_tokens", "temperature", "top_p")}
    return _t(spark, d, "predict_log").select("log_id", serving.invalid_field(F.col("prompt"), F.col("context"), **numbers).alias("invalid"))


@_query("SELECT log_id, request_id, prompt FROM predict_log WHERE log_id < 200")
def evaluation_head(spark, d):
    return records.head(_t(spark, d, "predict_log"), 200, "log_id").select("log_id", "request_id", "prompt")


# Run store

_KEYS = ("quality", "latency_ms", "memory_mb", "model_size_mb", "cost_per_1k_usd")


@_query("SELECT run_id, key, value FROM (UNPIVOT (SELECT run_id, quality, latency_ms, memory_mb, model_size_mb, cost_per_1k_usd FROM candidates) ON quality, latency_ms, memory_mb, model_size_mb, cost_per_1k_usd INTO NAME key VALUE value) WHERE isfinite(value)")
def metric_finite_filter(spark, d):
    return runs.finite_metrics(runs.long_metrics(_t(spark, d, "candidates"), ["run_id"], list(_KEYS)))


@_query(
    "WITH done AS (SELECT * FROM candidates WHERE _idx % 4 <> 1 ORDER BY start_time DESC NULLS LAST, run_id LIMIT 25), c AS (SELECT * FROM done WHERE isfinite(quality)) SELECT run_id, run_name, quality, "
    + ", ".join(f"CASE WHEN isfinite({k}) THEN {k} ELSE 0.0::double END AS {k}" for k in _KEYS[1:])
    + ", coalesce(is_baseline, false) AS is_baseline FROM c"
)
def run_candidates(spark, d):
    """The newest 25 finished runs; every fourth run failed."""
    c = _t(spark, d, "candidates")
    status = F.when(F.col("_idx") % 4 == 1, "FAILED").otherwise("FINISHED")
    store = c.select("run_id", "run_name", status.alias("status"), "start_time", F.create_map(F.lit("arm"), F.when(F.col("is_baseline"), "baseline").otherwise("arm")).alias("tags"))
    metrics = runs.long_metrics(c, ["run_id"], list(_KEYS)).withColumn("step", F.lit(0).cast("bigint")).withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    return runs.candidates_from_runs(store, metrics, {k: k for k in _KEYS}, "quality", 25).drop("metadata")


@_query("WITH a AS (SELECT model, client AS alias, log_id AS version, ts FROM predict_log) SELECT model, alias, arg_max(version, (ts, version)) AS version FROM a GROUP BY model, alias")
def alias_resolution(spark, d):
    return runs.current_versions(_t(spark, d, "predict_log").select("model", F.col("client").alias("alias"), F.col("log_id").alias("version"), "ts"))


@_query(
    f"""WITH c AS (SELECT client, count(*) AS requests, count(*) FILTER (WHERE coalesce(finish_reason = 'error', false)) AS errors, coalesce(sum(completion_tokens), 0)::bigint AS tokens FROM predict_log GROUP BY client),
 l AS (SELECT client, latency_ms, row_number() OVER (PARTITION BY client ORDER BY ts DESC, log_id DESC) AS k FROM predict_log WHERE latency_ms IS NOT NULL),
 s AS (SELECT client, round(avg(latency_ms), 9) AS mean_ms, {S.pick("latency_ms", 0.95, "round")} AS p95_ms FROM l WHERE k <= 1000 GROUP BY client) SELECT client, requests, errors, tokens, mean_ms, p95_ms FROM c LEFT JOIN s USING (client)"""
)
def request_metrics_last1000(spark, d):
    log = _t(spark, d, "predict_log").select("log_id", "client", "ts", "latency_ms", "finish_reason", "completion_tokens")
    failed = F.coalesce(F.col("finish_reason") == "error", F.lit(False))
    m = stats.request_metrics(log, ["client"], "latency_ms", failed, [F.desc("ts"), F.desc("log_id")], "completion_tokens")
    return m.select("client", "requests", "errors", "tokens", F.round("mean_ms", 9).alias("mean_ms"), "p95_ms")


# Streams


def _stream(spark, d, name) -> DataFrame:
    return spark.readStream.schema(_t(spark, d, name).schema).parquet(f"{d}/{name}.parquet*")


@_query(
    f"""WITH c AS (SELECT model AS name, count(*) AS requests, count(*) FILTER (WHERE coalesce(finish_reason = 'error', false)) AS errors, coalesce(sum(completion_tokens), 0)::bigint AS tokens FROM predict_log GROUP BY model),
 l AS (SELECT model AS name, latency_ms, row_number() OVER (PARTITION BY model ORDER BY ts DESC, log_id DESC) AS k FROM predict_log WHERE latency_ms IS NOT NULL),
 s AS (SELECT name, round(avg(latency_ms), 9) AS mean_ms, {S.pick("latency_ms", 0.95, "round")} AS p95_ms, count(*)::int AS held FROM l WHERE k <= 1000 GROUP BY name) SELECT * FROM c JOIN s USING (name)"""
)
def stream_request_metrics(spark, d):
    log = _stream(spark, d, "predict_log").select(F.col("model").alias("name"), F.col("ts").alias("at"), F.col("log_id").alias("seq"), F.col("latency_ms").alias("ms"), F.coalesce(F.col("finish_reason") == "error", F.lit(False)).alias("failed"), F.coalesce("completion_tokens", F.lit(0)).cast("bigint").alias("tokens"))
    out = requests.run_to_table(requests.request_metrics(log), "update")
    last = out.groupBy("name").agg(F.max_by(F.struct("requests", "errors", "tokens", "mean_ms", "p95_ms", "held"), "requests").alias("s"))
    return last.select("name", "s.requests", "s.errors", "s.tokens", F.round("s.mean_ms", 9).alias("mean_ms"), "s.p95_ms", "s.held")


@_query(S.with_(S.REC, S.RULED) + "SELECT coalesce(failed, 'kept') AS reason, count(*) AS n FROM ruled GROUP BY 1")
def stream_drop_counts(spark, d):
    return requests.run_to_table(requests.drop_counts(records.normalize(_stream(spark, d, "raw_instructions"), "raw_instructions")), "complete")


@_query("SELECT model AS run_id, log_id AS step, latency_ms AS value, max(latency_ms) OVER (PARTITION BY model ORDER BY log_id ROWS UNBOUNDED PRECEDING) AS peak FROM predict_log")
def stream_running_peak(spark, d):
    steps = _stream(spark, d, "predict_log").select(F.col("model").alias("run_id"), F.col("log_id").alias("step"), F.col("latency_ms").alias("value"))
    return requests.run_to_table(requests.running_peaks(steps), "append")


# Names


@_query("SELECT DISTINCT k, CASE WHEN starts_with(k, 'eval_') THEN 'eval/' || substr(k, 6) ELSE 'train/' || k END AS metric FROM (SELECT 'eval_' || event_type AS k FROM events UNION ALL SELECT event_type FROM events)")
def metric_keys(spark, d):
    e = _t(spark, d, "events").select("event_type")
    k = e.select(F.concat(F.lit("eval_"), "event_type").alias("k")).unionByName(e.select(F.col("event_type").alias("k"))).distinct()
    return k.select("k", T.metric_key(F.col("k")).alias("metric"))


@_query("SELECT _idx, CASE WHEN length(context) > 490 THEN substr(context, 1, 487) || '...' ELSE context END AS value FROM raw_instructions")
def param_truncation(spark, d):
    return _t(spark, d, "raw_instructions").select("_idx", T.truncated_param(F.col("context")).alias("value"))


@_query(
    "WITH n AS (SELECT run_id, '/org/' || method || '/' || run_id AS path, 'cat.' || method || '.' || run_id AS fqn FROM candidates) SELECT run_id, list_last(string_split(path, '/')) AS short_name, replace(trim(path, '/'), '/', '-') AS flat_path, length(fqn) - length(replace(fqn, '.', '')) = 2 AS three_level, 'models:/' || fqn || '@champion' AS alias_uri, 'models:/' || fqn || '/1' AS version_uri, 'runs:/' || run_id || '/model' AS run_uri FROM n"
)
def model_names(spark, d):
    c = _t(spark, d, "candidates").select("run_id", F.concat(F.lit("/org/"), "method", F.lit("/"), "run_id").alias("path"), F.concat(F.lit("cat."), "method", F.lit("."), "run_id").alias("fqn"))
    return c.select("run_id", T.short_name(F.col("path")).alias("short_name"), T.flat_path(F.col("path")).alias("flat_path"), T.is_three_level(F.col("fqn")).alias("three_level"), runs.model_uri(F.col("fqn"), "champion").alias("alias_uri"), runs.model_uri(F.col("fqn"), version=1).alias("version_uri"), runs.run_uri(F.col("run_id"), "model").alias("run_uri"))


# Selection


def _candidates(spark, d) -> DataFrame:
    return selection.candidates(_t(spark, d, "candidates"))


_N = ("quality", "latency", "memory", "model_size", "cost")


@_query(S.with_(S.CAND, S.NORMED) + "SELECT run_id, " + ", ".join(f"round(n_{a}, 6) AS n_{a}" for a in _N) + " FROM normed")
def normalize_axes(spark, d):
    return selection.normalized(_candidates(spark, d)).select("run_id", *[F.round(f"n_{a}", 6).alias(f"n_{a}") for a in _N])


@_query(S.with_(S.CAND, S.NORMED, S.UTIL) + "SELECT run_id, round(utility, 6) AS utility FROM util")
def utility(spark, d):
    return selection.with_utility(selection.normalized(_candidates(spark, d))).select("run_id", F.round("utility", 6).alias("utility"))


@_query(S.with_(S.CAND, S.NORMED, S.UTIL, S.GATED) + "SELECT run_id, reason FROM gated WHERE reason IS NOT NULL")
def constraints(spark, d):
    return selection.gated(_candidates(spark, d)).where(F.size("rejected_reasons") > 0).select("run_id", F.array_join("rejected_reasons", "; ").alias("reason"))


@_query(
    S.with_(S.CAND, S.NORMED, S.UTIL, S.GATED)
    + "SELECT run_id, concat_ws('; ', reason, CASE WHEN NOT is_baseline AND latency_ms > 300 THEN 'latency' END, CASE WHEN NOT is_baseline AND memory_mb > 4000 THEN 'memory' END) AS reasons FROM gated"
)
def constraint_caps(spark, d):
    g = selection.gated(_candidates(spark, d), SelectionConfig(max_latency_ms=300.0, max_memory_mb=4000.0))
    return g.select("run_id", F.array_join("rejected_reasons", "; ").alias("reasons"))


@_query(S.with_(S.CAND, S.NORMED, S.UTIL, S.GATED) + "SELECT g.run_id, r.rank, round(g.utility, 6) AS utility FROM gated g JOIN ranking r USING (_idx)")
def champion_ranking(spark, d):
    return selection.ranked(_candidates(spark, d)).select("run_id", F.col("rank").cast("bigint").alias("rank"), F.round("utility", 6).alias("utility"))


@_query(
    S.with_(S.CAND, S.NORMED, S.UTIL, S.GATED, S.FRONT)
    + "SELECT g.run_id, CASE WHEN r.rank = 1 THEN 'champion' WHEN r.rank = 2 THEN 'challenger' WHEN g.is_baseline THEN 'baseline' WHEN g.reason IS NOT NULL THEN 'rejected: ' || g.reason ELSE '-' END AS status, g._idx IN (SELECT _idx FROM front) AS on_pareto_frontier FROM gated g LEFT JOIN ranking r USING (_idx)"
)
def selection_status(spark, d):
    return selection.status(_candidates(spark, d)).select("run_id", "status", "on_pareto_frontier")


@_query(S.with_(S.CAND, S.FRONT) + "SELECT run_id FROM front")
def pareto_frontier(spark, d):
    return selection.pareto(_candidates(spark, d)).select("run_id")


@_query(
    S.with_(S.CAND, S.NORMED, S.UTIL, S.GATED)
    + "SELECT c.run_id AS champion, b.run_id AS baseline, round(c.quality - b.quality, 9) AS quality_gain, round(CASE WHEN c.latency_ms > 0 THEN b.latency_ms / c.latency_ms END, 6) AS speedup FROM (SELECT g.* FROM gated g JOIN ranking r USING (_idx) WHERE r.rank = 1) c FULL JOIN base b ON true"
)
def champion_gains(spark, d):
    g = selection.gains(_candidates(spark, d))
    return g.select("champion", "baseline", F.round("quality_gain", 9).alias("quality_gain"), F.round("speedup", 6).alias("speedup"))


@_query(
    S.with_(S.CAND, "base AS (SELECT * FROM cand WHERE is_baseline ORDER BY _idx LIMIT 1)")
    + "SELECT c.run_id, c.run_name, c.method, "
    + ", ".join(f"round(round(c.{k}, {n}) / nullif(b.{k}, 0), 3) AS {k}_vs_baseline" for k, n in (("quality", 4), ("latency_ms", 1), ("memory_mb", 1), ("model_size_mb", 1)))
    + " FROM cand c CROSS JOIN base b WHERE NOT c.is_baseline"
)
def relative_to_baseline(spark, d):
    return selection.relative_to_baseline(_candidates(spark, d))


@_query(
    S.with_(S.CAND, S.FRONT)
    + "SELECT run_name, method, round(quality, 4) AS quality, round(latency_ms, 1) AS latency_p95_ms, round(memory_mb, 1) AS peak_memory_mb, round(model_size_mb, 1) AS model_size_mb, round(cost_per_1k_usd, 5) AS cost_per_1k_usd, is_baseline, run_id, dataset_version, coalesce(run_name IN (SELECT run_name FROM front WHERE run_name IS NOT NULL), false) AS on_pareto_frontier FROM cand"
)
def experiment_results(spark, d):
    return selection.experiment_results(_candidates(spark, d))


@_query(S.with_(S.CAND) + "SELECT run_id, quality FROM cand ORDER BY quality DESC, _idx LIMIT 10")
def best_by_quality(spark, d):
    return selection.by_quality(_candidates(spark, d), 10).select("run_id", "quality")


@_query(S.with_(S.CAND, S.NORMED, S.UTIL, S.GATED) + "SELECT run_id AS champion, quality AS champion_quality, best_quality, round(best_quality - quality, 9) AS given_up FROM (SELECT g.*, r.rank, max(g.quality) OVER () AS best_quality FROM gated g JOIN ranking r USING (_idx)) WHERE rank = 1")
def champion_against_best(spark, d):
    return selection.against_best_quality(_candidates(spark, d)).withColumn("given_up", F.round("given_up", 9))


# Files


def _derived(spark, d: str, kind: str) -> str:
    """A file that source readers have to get right, written from a table once per call."""
    rows = _t(spark, d, "raw_instructions").select("_idx", "instruction", "context", "response")
    line = F.to_json(F.struct("_idx", "instruction", "context", "response"), {"ignoreNullFields": "false"})
    if kind == "array":
        # Items that are no objects stand between the records.
        lines = rows.select("_idx", F.concat(F.when(F.col("_idx") == 0, '[5, "x", ').otherwise(", [1], "), line).alias("value"))
        end = spark.createDataFrame([(1 << 62, "]")], "_idx bigint, value string")
        path = new_path(spark, "array")
        lines.unionByName(end).repartition(1).sortWithinPartitions("_idx").select("value").write.text(path)
        return spark.read.text(path).inputFiles()[0]
    # Mislabelled: lines in a .json file, by falling number, so that source order is not the order of the values.
    path = new_path(spark, "lines")
    rows.select("_idx", line.alias("value")).repartition(1).sortWithinPartitions(F.desc("_idx")).select("value").write.text(path)
    return spark.read.text(path).inputFiles()[0]


@_query("SELECT _idx, instruction, response FROM raw_instructions")
def json_array_file(spark, d):
    return files.read_json_file(spark, _derived(spark, d, "array")).select("_idx", "instruction", "response")


@_query("SELECT _idx, instruction, response FROM raw_instructions")
def mislabelled_json_file(spark, d):
    return files.read_json_file(spark, _derived(spark, d, "lines")).select("_idx", "instruction", "response")


@_query(f"WITH o AS (SELECT row_number() OVER (ORDER BY _idx DESC) - 1 AS place, {S.clean('instruction')} AS instruction, {S.clean('response')} AS response FROM raw_instructions) SELECT place, instruction, response FROM o WHERE place < 100")
def source_order_head(spark, d):
    """The first rows of a file without ordinals are those that stand first in it."""
    return files.load_records(spark, _derived(spark, d, "lines"), "jsonl", 100).select(F.col("_idx").alias("place"), "instruction", "response")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

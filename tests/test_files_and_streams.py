import json

import pytest
from pyspark.sql import functions as F

from lodestone.cli import prepare
from lodestone.config import load_config
from lodestone.operators import records as R
from lodestone.sources import files
from lodestone.streaming import requests


def test_json_readers(spark, tmp_path):
    a, b, c, d = (str(tmp_path / n) for n in ("a.json", "b.json", "c.jsonl", "d.jsonl"))
    open(a, "w").write('[\n {"instruction": "x",\n  "response": "y"}\n]')
    open(b, "w").write('{"instruction": "x", "response": "y"}\n\n{"instruction": "z", "response": "w"}\n')
    open(c, "w").write('{"instruction": "x", "response": "y"}\n\n{"instruction": \n')
    open(d, "w").write('{"id": "1", "instruction": "x", "response": "y"}\n')
    assert files.read_data_file(spark, a).count() == 1
    assert files.read_data_file(spark, b).count() == files.read_jsonl_strict(spark, b).count() == 2
    with pytest.raises(ValueError, match=r"c\.jsonl:3 is not valid JSON"):
        files.read_jsonl_strict(spark, c)
    with pytest.raises(FileNotFoundError):
        files.read_jsonl_strict(spark, str(tmp_path / "none.jsonl"))
    assert files.read_records_jsonl(spark, d).first().context is None
    with pytest.raises(ValueError):
        files.load_records(spark, d, "ftp")


def test_hub_files_prefer_the_split(spark, tmp_path):
    (tmp_path / "data").mkdir()
    for name in ("train-0.jsonl", "test-0.jsonl"):
        (tmp_path / "data" / name).write_text(json.dumps({"instruction": name, "response": "r"}) + "\n")
    got = files.read_hub_files(spark, str(tmp_path), "train").collect()
    assert [r.instruction for r in got] == ["train-0.jsonl"]


def test_round_trip(spark, tmp_path, records_schema):
    r = R.normalize(spark.createDataFrame([(0, "a", "What é?", "", "That.", "c")], records_schema).withColumn("extra", F.lit(1)), "t")
    path = files.write_jsonl(r.drop("_idx"), str(tmp_path / "out"), single_file=True)
    back = spark.read.json(path).first()
    assert back.instruction == "What é?" and back.meta.extra == 1
    assert files.folder_mb(spark, path) > 0 == files.folder_mb(spark, str(tmp_path / "nothing"))
    files.create_schema(spark, "bronze")
    files.save_table(r, "bronze.raw")
    assert files.load_records(spark, "bronze.raw", "table", idx="_idx").count() == 1
    spark.sql("DROP SCHEMA bronze CASCADE")
    assert files.read_json_report(files.write_json_report({"a": 1}, tmp_path / "r" / "x.json")) == {"a": 1}


def test_prepare(spark, small, tmp_path):
    # Without ids and ordinals: both are made.
    spark.read.parquet(f"{small}/raw_instructions.parquet").drop("id", "_idx").write.parquet(f"{tmp_path}/in.parquet")
    s = prepare(spark, load_config(overrides={"data.source": f"{tmp_path}/in.parquet"}, env={}), f"{tmp_path}/out")
    assert s["kept"] == sum(s["splits"].values()) and s["dropped"] == sum(s["drops"].values())
    assert spark.read.parquet(f"{tmp_path}/out/train").count() == s["splits"]["train"]


def test_last_requests_stream(spark, small, tmp_path):
    log = spark.read.parquet(f"{small}/predict_log.parquet").select(F.col("model").alias("name"), F.col("ts").alias("at"), F.col("log_id").alias("seq"), F.col("latency_ms").alias("ms"), F.coalesce(F.col("finish_reason") == "error", F.lit(False)).alias("failed"), F.lit(2).cast("bigint").alias("tokens"))
    log.write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
    q = requests.request_metrics(stream).writeStream.format("memory").queryName("last").outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.name: r for r in spark.table("last").collect()}
    for r in log.groupBy("name").agg(F.count("*").alias("n"), F.count_if("failed").alias("e"), F.count("ms").alias("k"), F.avg("ms").alias("m")).collect():
        assert (got[r.name].requests, got[r.name].errors, got[r.name].held) == (r.n, r.e, r.k) and abs(got[r.name].mean_ms - r.m) < 1e-6


def test_metric_and_drop_streams(spark, tmp_path, records_schema):
    spark.createDataFrame([("r", "k", 1.0, 0, None), ("r", "k", float("inf"), 1, None)], "run_id string, key string, value double, step bigint, ts timestamp").write.parquet(f"{tmp_path}/m")
    s = spark.readStream.schema("run_id string, key string, value double, step bigint, ts timestamp").parquet(f"{tmp_path}/m")
    requests.forward_metrics(s, f"{tmp_path}/store", f"{tmp_path}/cp").awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/store").count() == 1
    rec = R.normalize(spark.createDataFrame([(0, "a", "A fine instruction", "", "x", ""), (1, "b", "no", "", "x", "")], records_schema), "t")
    rec.write.parquet(f"{tmp_path}/rec")
    st = spark.readStream.schema(rec.schema).parquet(f"{tmp_path}/rec")
    requests.drop_counts(st).writeStream.format("memory").queryName("drops").outputMode("complete").trigger(availableNow=True).start().awaitTermination(60)
    assert {r.reason: r.n for r in spark.table("drops").collect()} == {"kept": 1, "instruction_too_short": 1}


def test_percentile_of_the_stream():
    assert requests.tail_value([], 0.95) == 0.0 and requests.tail_value([3, 1, 2], 0.5) == 2

import json
import threading
import urllib.error
import urllib.request
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestone import cli, serving
from lodestone.config import load_config
from lodestone.operators import evaluation, quality, records, runs, selection, stats
from lodestone.report import model_card, selection_report, tradeoff_markdown
from lodestone.sources import files


def test_array_keeps_its_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text(' \n[{"instruction": "a", "response": "x"}, 5, "x", [1], null, {"instruction": "b", "n": 2}]')
    got = files.read_json_file(spark, str(tmp_path / "a.json")).collect()
    assert [(r.instruction, r.response, r.n) for r in got] == [("a", "x", None), ("b", None, 2)]
    (tmp_path / "bad.json").write_text('[{"instruction": "a"}, ')
    with pytest.raises(Exception, match="(?i)malformed|json"):
        files.read_json_file(spark, str(tmp_path / "bad.json")).collect()


def test_array_beyond_the_size_of_one_value(spark, tmp_path):
    text = "x" * (1 << 20)
    with open(tmp_path / "a.json", "w") as f:
        f.write('[{"n": 0, "t": "' + text + '"}')
        for n in range(1, 135):
            f.write(f', [1], {{"n": {n}, "t": "{text}"}}')
        f.write("]")
    got = files.read_json_file(spark, str(tmp_path / "a.json")).select("n", F.length("t").alias("t")).orderBy("n").collect()
    assert [(r.n, r.t) for r in got] == [(n, 1 << 20) for n in range(135)]


def test_array_over_many_splits(spark, tmp_path):
    """Objects, strings and escapes that span splits, in every layout; what is no JSON raises."""
    import random

    rng = random.Random(4)
    signs = ["}", "{", "[", "]", '"', "\\", ",", "\n", "\r", "a", "\u00e9", "\u20ac", "\u2028", " "]
    word = lambda n: "".join(rng.choice(signs) for _ in range(rng.randrange(n)))
    items = []
    for i in range(400):
        items.append({"i": i, "s": word(90 if i % 100 else 30000), "d": {"x": [{"y": word(9)}, {}], "}": None}})
        items += rng.choice([[], [], [5], [word(20), [{"i": -1}, "}"]], [None, True, 1.5e3]])
    objects = [x for x in items if isinstance(x, dict)]
    whole = json.dumps(items)
    texts = [whole, json.dumps(items, indent=2, ensure_ascii=False) + "\n\n", "\ufeff \r\n" + json.dumps(items, ensure_ascii=False)]
    bad = [whole + "}", whole + "]", whole[:-1], whole[:-2], whole.replace(', {"i": 300', ' {"i": 300'), whole.replace('{"i": 200', ',{"i": 200'), whole.replace('"i": 100', '"i": NaN'), whole[:-1] + ",]", whole + whole, whole[:5000] + whole[6000:]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        for k, text in enumerate(texts):
            (tmp_path / f"{k}.json").write_bytes(text.encode())
            rows = files.in_source_order(files.read_json_file(spark, str(tmp_path / f"{k}.json"))).orderBy("_idx").collect()
            assert [(r.i, r.s, r.d.x[0].y) for r in rows] == [(x["i"], x["s"], x["d"]["x"][0]["y"]) for x in objects]
        assert spark.read.text(str(tmp_path / "0.json"), lineSep="}").rdd.getNumPartitions() > 10
        for k, text in enumerate(bad):
            (tmp_path / f"bad{k}.json").write_bytes(text.encode())
            with pytest.raises(Exception, match="is not valid JSON"):
                files.read_json_file(spark, str(tmp_path / f"bad{k}.json")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for k, (text, want) in enumerate([("[]", 0), (" [ 1, {}, \"}\" ] \n", 1), ('[{"a": 1}]', 1), ("[[{}]]", 0), ('[{"a": 1}, 2]', 1)]):
        (tmp_path / f"small{k}.json").write_text(text)
        assert files.read_json_file(spark, str(tmp_path / f"small{k}.json")).count() == want


def test_rows_keep_the_order_of_the_source(spark, tmp_path):
    names = ["z", "y", "x", "a", "b", "c"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.jsonl").write_text("".join(json.dumps({"instruction": n, "response": "r"}) + "\n" for n in names[:4]))
    (tmp_path / "d" / "2.jsonl").write_text("".join(json.dumps({"instruction": n, "response": "r"}) + "\n" for n in names[4:]))
    whole = files.load_records(spark, str(tmp_path / "d"), "jsonl").orderBy("_idx").collect()
    assert [(r._idx, r.instruction) for r in whole] == list(enumerate(names))
    assert [r.instruction for r in files.load_records(spark, str(tmp_path / "d"), "jsonl", 2).orderBy("_idx").collect()] == ["z", "y"]
    spark.createDataFrame([(n, "r") for n in names], "question string, answer string").repartition(1).write.parquet(str(tmp_path / "p"))
    assert {r.instruction for r in files.load_records(spark, str(tmp_path / "p"), "parquet", 3).collect()} <= set(names)
    many = spark.range(5000).selectExpr("cast(id as string) instruction", "'r' response")
    many.repartition(1).sortWithinPartitions("instruction").write.json(str(tmp_path / "big"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        split = files.in_source_order(spark.read.json(str(tmp_path / "big"))).orderBy("_idx").collect()
        assert spark.read.json(str(tmp_path / "big")).rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r._idx for r in split] == list(range(5000)) and [r.instruction for r in split] == sorted(map(str, range(5000)))


def test_downloaded_files_are_shuffled_by_seed(spark, tmp_path):
    for name in ("Validation-0.jsonl", "train-0.jsonl", "train-1.json"):
        (tmp_path / name).write_text("".join(json.dumps({"instruction": f"{name} {i}", "response": "r"}) + "\n" for i in range(20)))
    load = lambda **k: [r.instruction for r in files.load_records(spark, str(tmp_path), "hf", **k).orderBy("_idx").collect()]
    train = load(seed=1)
    assert len(train) == 40 and all(x.startswith("train") for x in train) and train == load(seed=1) != load(seed=2)
    assert load(seed=1, max_examples=7) == train[:7] and len(load(split="validation")) == 20


def test_judging_moves_no_text_and_scans_once(spark, small):
    r = records.normalize(spark.read.parquet(f"{small}/raw_instructions.parquet"), "t")
    thin = records.judged(r, keep=())
    assert thin.columns == ["_idx", "content_hash", "reason"]
    assert not any("raw_instructions" in f for f in thin.inputFiles())
    full = records.judged(r)
    assert sorted(map(tuple, full.select(*thin.columns).collect())) == sorted(map(tuple, thin.collect()))
    parts = [records.limb_sums(full.where(f"_idx % 2 = {k}")).first().limbs for k in (0, 1)]
    assert records.sum_of_limbs(*parts) == records.sum_of_limbs(records.limb_sums(full).first().limbs) != records.sum_of_limbs(parts[0])


def test_ranks_of_any_values(spark):
    import random

    rng = random.Random(8)
    values = [float("inf"), float("-inf"), 0.0, -0.0, 1e-320, -1e300, 7.0] + [rng.choice([rng.gauss(0, 1e6), rng.random(), -3.5, 12.0]) for _ in range(600)]
    rows = [(i % 3 if i % 7 else None, v) for i, v in enumerate(values)] + [(1, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    ranks = {"least": lambda n: n * 0, "middle": lambda n: F.floor(n / 2), "top": lambda n: n - 1}
    for r in stats.at_ranks(df, ["g"], "v", ranks).collect():
        own = sorted(v for g, v in rows if g == r.g and v is not None)
        assert (r.least, r.middle, r.top) == (own[0], own[len(own) // 2], own[-1])
    one = stats.at_ranks(df, [], "v", ranks).first()
    assert one.middle == sorted(values)[len(values) // 2]
    assert stats.at_ranks(df.limit(0), [], "v", ranks).first().middle == 0.0


def test_frontier_against_all_pairs(spark):
    import random

    rng = random.Random(3)
    rows = [(i, *(rng.randint(0, 6) / 2 for _ in range(5)), False) for i in range(900)]
    cols = ["quality", "latency_ms", "memory_mb", "model_size_mb", "cost_per_1k_usd"]
    df = spark.createDataFrame(rows, "_idx bigint, " + ", ".join(f"{c} double" for c in cols) + ", is_baseline boolean").repartition(7)
    good = [(r[1], *(-x for x in r[2:6])) for r in rows]
    want = {i for i, a in enumerate(good) if not any(b != a and all(x >= y for x, y in zip(b, a)) for b in good)}
    assert {r._idx for r in selection.pareto(df).collect()} == want
    assert selection.pareto(df.limit(0)).count() == 0


def test_store_keeps_artifacts_and_versions_apart(spark, tmp_path):
    s = runs.Store(spark, f"file://{tmp_path}/store")
    s.start_run("r1", "one", {"arm": "lora"})
    assert s.tags_of("r1") == {"arm": "lora"} and s.tags_of("none") == {}
    assert s.log_report("r1", {"rouge_l": 0.5, "name": "x", "bad": float("nan")}, "# Samples") and s.log_fingerprint("r1", {"num_examples": 3, "content_hash": "ab"})
    assert {(r.key, r.value) for r in s.table("metrics").collect()} == {("eval/rouge_l", 0.5), ("data/num_examples", 3.0)}
    assert {r.path for r in s.table("artifacts").collect()} == {"evaluation/samples.md", "evaluation/evaluation_report.json", "data/dataset_fingerprint.json"}
    # A version that another writer has taken, but not yet recorded, is left to that writer.
    assert s.register("m", "r1") == 1
    taken = next(Path(f"{tmp_path}/store/_taken").glob("*-1"))
    (taken.parent / taken.name.replace("-1", "-2")).touch()
    assert s.register("m", "r1") == 3
    assert not s.tolerant(lambda: 1 / 0, "nothing")
    assert runs.numbers("a", {"x": 1.234, "y": True, "z": "t"}, {"x": 1}) == {"a/x": 1.2} and runs.environment()["python"] and runs.seed_everything(3) == 3


def test_requests(spark):
    rows = [("ok", None, 10, 0.5, 0.9), ("", None, 10, 0.5, 0.9), (None, None, None, None, None), ("x", "c" * 16001, 1, 0.0, 1.0), ("x", None, 0, 0.0, 1.0), ("x", None, 1025, 0.0, 1.0), ("x", None, 1, 2.1, 1.0), ("x", None, 1, 2.0, 0.0), ("x" * 8001, None, 1, 0.0, 1.0), ("x", "c", None, None, None)]
    names = ("max_new_tokens", "temperature", "top_p")
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, prompt string, context string, max_new_tokens int, temperature double, top_p double")
    got = [r.bad for r in df.select("i", serving.invalid_field(F.col("prompt"), F.col("context"), **{n: F.col(n) for n in names}).alias("bad")).orderBy("i").collect()]
    assert got == [None, "prompt", "prompt", "context", "max_new_tokens", "max_new_tokens", "temperature", "top_p", "prompt", None]
    for row, bad in zip(rows, got):
        assert serving.checked({k: v for k, v in zip(("prompt", "context", *names), row) if v is not None}) == bad


def test_stub_server():
    with serving.server(0) as s:
        threading.Thread(target=s.serve_forever, daemon=True).start()
        url = f"http://127.0.0.1:{s.server_address[1]}"
        ask = lambda body: json.load(urllib.request.urlopen(urllib.request.Request(f"{url}/predict", data=body)))
        assert ask(b'{"prompt": "hello"}')["prediction"].endswith("hello") and json.load(urllib.request.urlopen(f"{url}/health"))["status"] == "ok"
        for body in (b'{"prompt": ""}', b"{", b"[1]"):
            with pytest.raises(urllib.error.HTTPError) as e:
                ask(body)
            assert e.value.code == 422
        s.shutdown()


def test_commands(spark, small, tmp_path, capsys):
    assert cli.main(["version"]) == 0
    c, out = f"{small}/candidates.parquet", str(tmp_path / "out")
    config = load_config(env={})
    assert cli.select(spark, config, c, out) in (0, 2)
    report = files.read_json_report(f"{out}/selection.json")
    assert len(report["ranked"]) + len(report["rejected"]) == selection.candidates(spark.read.parquet(c)).count()
    assert "Champion" in tradeoff_markdown(report) and tradeoff_markdown({}).endswith("none")
    assert cli.register(spark, config, c, f"file://{tmp_path}/store", True) in (0, 2)
    pairs = [(f"r{i % 2}", i, "ask", "a b c", "a b d" if i % 3 else "a b c", 10.0 + i, 5) for i in range(40)]
    spark.createDataFrame(pairs, "run_id string, _idx int, instruction string, prediction string, reference string, latency_ms double, completion_tokens int").write.parquet(str(tmp_path / "pred"))
    (tmp_path / "eval").mkdir()
    got = cli.evaluate(spark, load_config(overrides={"evaluation.max_eval_samples": 6}, env={}), str(tmp_path / "pred"), str(tmp_path / "eval"))["runs"]
    assert [r["num_eval_examples"] for r in got] == [6, 6] and all(0 < r["rouge_l"] <= 1 and r["p95_ms"] > 10 for r in got)
    assert "# Samples" in (tmp_path / "eval" / "samples.md").read_text()
    card = model_card({"run_name": "one", "run_id": "r1", "params": {"lora.r": "8"}, "tags": {"arm": "lora"}}, {"quality/rouge_l": 0.5, "other": 2}, {"rows": 3})
    assert "lora.r" in card and "quality/rouge_l" in card and "## Limits" in card


def test_first_rows_of_each_run_and_sample_texts(spark):
    df = spark.createDataFrame([(f"r{i % 2}", i, "p", "q") for i in range(300)], "run_id string, _idx int, prediction string, reference string")
    assert sorted(r._idx for r in evaluation.first_of_each(df, "run_id", 3).collect()) == [0, 1, 2, 3, 4, 5]
    assert evaluation.first_of_each(df, "run_id", None) is df
    chosen = quality.best_and_worst(quality.scored(df).select("run_id", "_idx", "rouge_l"), "run_id", "rouge_l", worst=1, best=1)
    texts = df.select("_idx", F.repeat(F.lit("x"), 900).alias("instruction"), "reference", "prediction")
    assert {(r._idx, len(r.instruction)) for r in quality.with_texts(chosen, texts).collect()} == {(0, 400), (1, 400), (298, 400), (299, 400)}


def test_parameter_totals(spark):
    rows = [("a", 10, 2, "Parameter", True, False), ("a", 10, 1, "Params4bit", False, False), ("a", 100, 4, "Parameter", None, True), ("b", None, None, None, None, None)]
    t = {r.m: r for r in stats.parameter_totals(spark.createDataFrame(rows, "m string, numel bigint, element_size int, kind string, trainable boolean, buffer boolean"), ["m"]).collect()}
    assert (t["a"].params_total, t["a"].params_trainable, t["a"].params_frozen, t["a"].bytes) == (30, 10, 20, 430)
    assert round(t["a"].params_trainable_pct, 3) == 33.333 and t["b"].params_total == 0 and t["b"].params_trainable_pct == 0.0

import time

import pytest

from lodestone import pipeline, probes, serving
from lodestone.operators import prompts, stats


def test_steps_wait_for_all_they_need():
    seen = []

    def arm(name):
        def step(done):
            assert done["prepare"] == 3
            time.sleep(0.05)
            seen.append(name)
            return name

        return step

    steps = {"prepare": (lambda d: 3, ()), "a": (arm("a"), ("prepare",)), "b": (arm("b"), ("prepare",)), "evaluate": (lambda d: sorted(seen), ("a", "b"))}
    assert pipeline.run(steps)["evaluate"] == ["a", "b"]
    assert pipeline.run({}) == {}


def test_a_failure_stops_what_depends_on_it():
    ran = []
    steps = {"bad": (lambda d: 1 / 0, ()), "good": (lambda d: ran.append("good"), ()), "after": (lambda d: ran.append("after"), ("bad",))}
    with pytest.raises(ZeroDivisionError):
        pipeline.run(steps, 1)
    assert "after" not in ran
    for wrong in ({"a": (print, ("b",))}, {"a": (print, ("b",)), "b": (print, ("a",))}):
        with pytest.raises(ValueError):
            pipeline.run(wrong)


def test_probes(spark):
    calls = []
    rows = probes.latencies("r", lambda texts: calls.append(len(texts)) or 7, prompt_tokens=30, batches=(1, 4), warmup=2, measured=5)
    assert len(rows) == 10 and len(calls) == 14 and {r[2] for r in rows} == {1, 4} and all(r[3] >= 0 and r[4] == 7 for r in rows)
    assert len(probes.synthetic_prompt(30).split()) == 30
    s = stats.latency_summary(spark.createDataFrame(rows, probes.LATENCIES), ["batch_size"], "ms", "tokens").collect()
    assert {r.batch_size: r.n for r in s} == {1: 5, 4: 5}
    with pytest.raises(KeyError), probes.peak_memory() as found:
        held = bytearray(20 << 20)
        raise KeyError(len(held))
    assert found["peak_mb"] > 19 and found["host_rss_mb"] > 0


def test_any_tokenizer(spark):
    df = spark.createDataFrame([(1, "a bb", "ccc"), (2, None, "")], "i int, ask string, answer string")
    load = lambda: lambda texts: [[len(w) for w in t.split()] for t in texts]
    rows = prompts.encoded(df, load, {"ask": "p", "answer": "a"})
    assert [(r.p, r.a) for r in rows.orderBy("i").collect()] == [([1, 2], [3]), ([], [])]


def test_which_model_is_served():
    assert serving.model_to_serve("m", {}) == "m" and serving.model_to_serve(None, {"LODESTONE_MODEL_URI": "e"}) == "e" and serving.model_to_serve("m", {"LODESTONE_MODEL_URI": "e"}) == "m"
    assert serving.model_to_serve("m", {"LODESTONE_STUB": "1"}) is None and serving.model_to_serve(None, {}) is None

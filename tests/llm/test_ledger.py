import random
from collections import defaultdict

from pyspark.sql import functions as F

from lodestone.llm import ledger


def found(df):
    return sorted((r.keep_idx, r.copy_idx) for r in ledger.copies(df).collect())


def test_formatting_only(raw):
    df = raw(
        {"instruction": "Say it.", "response": "A b-c."}, {"instruction": "say  IT!", "context": "", "response": "“a B c”"}, {"instruction": "Say it.", "response": "A b d."},
        {"instruction": "Straße 1", "response": "x"}, {"instruction": "STRASSE 1", "context": " ", "response": "X"},
    )
    assert found(df) == [(0, 1), (3, 4)]


def test_names_in_any_order(raw):
    df = raw(
        {"instruction": "i", "response": '{"a": "1", "b": "x y"}'}, {"instruction": "i", "response": '{ "B":"X-Y","A":"1" }'}, {"instruction": "i", "response": "A: 1\nB: x y"}, {"instruction": "i", "response": "b : x  y\r\n\r\na : 1"},
        {"instruction": "i", "response": "a: 1 b: x y"}, {"instruction": "i", "response": "b: x y a: 1"}, {"instruction": "i", "response": '{"a": "x y", "b": "1"}'}, {"instruction": "i", "response": '{"a": "1", "b'},
    )
    # Flattened lines equal the record of the same letters; a flattened other order is no list of pairs any more, but its letters are those of row 1.
    assert found(df) == [(0, 1), (0, 2), (0, 3), (0, 4), (0, 5)]


def test_nulls_empties_repeats_and_extra_columns(raw):
    df = raw({}, {"instruction": "", "context": " \n", "response": "—"}, {"instruction": "x" * 300_000}, {"instruction": "X" * 300_000}, idx=F.lit("clash"), plain_key=F.lit(1), copies=F.lit(2), _late=F.lit("z"), bucket=F.lit(0))
    assert found(df) == [(0, 1), (2, 3)]
    assert found(raw().limit(0)) == []
    twice = df.unionByName(df)
    assert found(twice) == [(0, 1), (0, 1), (2, 3), (2, 3)]
    assert sorted((r.keep_idx, r.copies) for r in ledger.collapsed(twice).collect()) == [(0, 4), (2, 4)]


def test_ledger_over_batches_equals_one_batch(raw, spark):
    rng = random.Random(4)
    rows = [{"instruction": rng.choice(["a b", "A-B", "c", "d"]), "response": rng.choice(["x", "X.", "y"])} for _ in range(400)]
    rows += [{"instruction": "hot", "response": "hot"}] * 200
    df = raw(*rows)
    keys = ledger.keyed(df).cache()
    whole = ledger.groups(ledger.update(ledger.empty_ledger(spark), ledger.summarize(keys)))
    grown = ledger.empty_ledger(spark)
    for k in range(3):
        grown = ledger.update(grown, ledger.summarize(keys.where(F.col("idx") % 3 == 2 - k)))
    as_set = lambda g: {(r.keep_idx, r.copies) for r in g.collect()}
    brute = defaultdict(list)
    for i, r in enumerate(rows):
        brute[tuple("".join(c for c in r[f].upper() if c.isalnum()) for f in ("instruction", "response"))].append(i)
    assert as_set(whole) == as_set(ledger.groups(grown)) == {(v[0], len(v)) for v in brute.values()}


def test_stored_ledger_touches_only_the_buckets_of_a_batch(raw, spark, tmp_path):
    rows = [{"instruction": f"task {i % 90}", "response": "done"} for i in range(300)]
    keys = ledger.keyed(raw(*rows)).cache()
    stored = ledger.Ledger(spark, f"file://{tmp_path}/ledger")
    assert stored.read().count() == 0
    stored.add(ledger.summarize(keys.where("idx < 250")))
    before = stored._current()[1]
    few = ledger.summarize(keys.where("idx >= 298"))
    touched = {r.bucket for r in few.collect()}
    stored.add(few)
    stored.add(ledger.summarize(keys.limit(0)))
    after = ledger.Ledger(spark, f"file://{tmp_path}/ledger")._current()[1]
    assert {b for b in after if after[b] != before.get(b)} == touched and len(touched) <= 2
    stored.add(ledger.summarize(keys.where("idx >= 250 and idx < 298")))
    assert sorted((r.keep_idx, r.copies) for r in ledger.groups(stored.read()).collect()) == [(i, 4 if i < 30 else 3) for i in range(90)]
    assert {r.bucket for r in stored.read(sorted(touched)).select("bucket").distinct().collect()} == touched


def test_hot_keys_and_long_names(raw, spark):
    name = "a name of far more than forty letters that still is a name"
    df = raw(*[{"instruction": "hot", "response": "hot"}] * 30, {"instruction": "i", "response": f"{name}: 1\nB: x"}, {"instruction": "i", "response": f"b: X\n{name}: 1"}, {"instruction": "z"})
    assert found(df) == [(0, i) for i in range(1, 30)] + [(30, 31)]
    keys = ledger.keyed(df)
    whole = ledger.update(ledger.empty_ledger(spark), ledger.summarize(keys))
    for hot in (1, 3, 1000):
        assert sorted((r.first_idx, r.idx) for r in ledger.classes(keys, whole, hot).collect() if r.idx != r.first_idx) == found(df)

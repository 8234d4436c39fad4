import random

import pytest
from pyspark.sql import functions as F

from lodestone.llm import overlap as O

SCHEMA = "gold_idx bigint, instruction string, context string, response string, source_name string"
I = "Who decided that the kiln of Ulmen should be bright, and was it in early spring?"  # noqa: E741
R = "The loom resembles the ferry over three seasons. It took 40 hours until the mill was stable again. The map limits the canal."


def run(spark, train, validation=(), test=(), extra=False):
    make = lambda rows: spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    dfs = [make(x) for x in (train, validation, test)]
    if extra:
        dfs = [d.withColumn("cls", F.lit("clash")).withColumn("split", F.lit(1)).withColumn("term", F.lit(2)) for d in dfs]
    return sorted((r.lo_idx, r.hi_idx, r.split) for r in O.pairs(*dfs).collect())


def test_copies_near_copies_and_others(spark):
    train = [(0, I, "", R), (1, I, None, "Something else entirely was the answer here, as always."), (2, "Who else was it?", "", R), (3, "Label this note from Ulm", "", "question"), (10, "Give the facts", "", "Year: 1850\nPlace: Ulm\nOwner: Bell")]
    val = [(4, I.upper(), "", R.replace(".", "!")), (5, I.replace("decided", "deicded"), "", R.replace("limits", "really limits")), (6, I, "a passage of its own", R)]
    test = [(7, "Label this note from Ulm", "", "complaint"), (8, "label this note from Ulm!", "", "Question."), (9, "give the facts.", "", '{"owner": "Bell", "place": "Ulm", "year": "1850"}')]
    got = run(spark, train, val, test, extra=True)
    assert got == [(0, 4, "validation"), (0, 5, "validation"), (3, 8, "test"), (9, 10, "test")]


def test_defined_cases(spark):
    assert run(spark, []) == run(spark, [(0, I, "", R)]) == run(spark, [], [(0, I, "", R)]) == []
    assert run(spark, [(0, None, None, None), (1, "", "", "")], [(2, None, "", None)]) == [(0, 2, "validation"), (1, 2, "validation")]
    long = " ".join(f"word{i}" for i in range(20_000))
    assert run(spark, [(0, long, long, long)], [], [(1, long + " more", long, long)]) == [(0, 1, "test")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    nouns = "kiln ferry loom bridge ledger mill canal map archive choir".split()
    sentence = lambda: f"The {rng.choice(nouns)} {rng.choice(['limits', 'guards', 'copies'])} the {rng.choice(nouns)} for {rng.randint(2, 90)} days"
    rows = []
    for i in range(60):
        base = [f"How does {rng.choice(nouns)} {i % 9} see the {rng.choice(nouns)} now?", rng.choice(["", "One shared passage of some words."]), ". ".join(sentence() for _ in range(rng.randint(1, 5))) + "."]
        rows.append(tuple(base))
        if rng.random() < 0.6:
            w = base[2].split()
            k = rng.randrange(len(w))
            w[k] = rng.choice(["now " + w[k], "", w[k]])
            rows.append((base[0].upper(), base[1], " ".join(w)))
    split = [rng.random() < 0.5 for _ in rows]
    train = [(i, *r) for i, r in enumerate(rows) if split[i]]
    test = [(i, *r) for i, r in enumerate(rows) if not split[i]]
    want = sorted((min(a[0], b[0]), max(a[0], b[0]), "test") for a in train for b in test if O.same_record(a[1:], b[1:]))
    assert run(spark, train, [], test) == want


def test_report(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    r = O.report(make([(0, I, "", R, "a")]), make([(1, I, "", R, "b"), (2, I, "", R, None)]), make([(3, I, "", R, "b")])).collect()
    assert sorted((x.split, x.source_name or "", x.pairs) for x in r) == [("test", "b", 1), ("validation", "", 1), ("validation", "b", 1)]


def test_every_accepted_edit_is_found(spark):
    """Changes in several runs of words, moved words included; the context may change too."""
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("abdegiklmnoprstuvz") for _ in range(6))
    train, test, want = [], [], []
    for i in range(120):
        rec = [[name() for _ in range(n)] for n in rng.choice([(8, 14, 12), (9, 40, 15), (14, 0, 14), (8, 0, 90), (150, 20, 150), (3, 25, 8), (20, 8, 0)])]
        other = [list(f) for f in rec]
        for f, n in zip(other, rng.choice([(2, 0, 2), (2, 2, 2), (1, 2, 1), (0, 2, 2)])):
            for k in rng.sample(range(len(f)), min(n, len(f))):
                f[k] = name()
        if i % 3 == 0:
            rng.shuffle(other[2])
        a, b = ((" ".join(f) for f in r) for r in (rec, other))
        train.append((i, *a))
        test.append((1000 + i, *b))
        if O.same_record(train[-1][1:], test[-1][1:]):
            want.append((i, 1000 + i, "test"))
    assert len(want) > 50 and run(spark, train, [], test) == want


def test_bounds_lose_no_pair():
    """Records that the definition accepts share a list in which the bounds let them meet, whatever the weights."""
    rng = random.Random(9)
    met = 0
    for _ in range(1500):
        vocabulary = [f"w{k}" for k in range(rng.choice([8, 40, 400]))]
        x = [[rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 5, 9, 14, 30, 60]))] for _ in range(3)]
        y = [list(f) for f in x]
        for f in y:
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                if f:
                    k = rng.randrange(len(f))
                    f[k : k + 1] = rng.choice([[], [rng.choice(vocabulary)], [f[k], "more"], [f[k][1:] + f[k][:1]]])
        a, b = (tuple(" ".join(f) for f in r) for r in (x, y))
        if not O.same_record(a, b):
            continue
        weighted = O.Terms([rng.choice([1.0, 1.5, 4.0]) for _ in range(O.BUCKETS)], [(1 << 64) - 1] * O.BUCKETS)
        memo = {}
        sides = []
        for r, train_only in ((a, True), (b, False)):
            listed, norms = O.terms([weighted(O.hashes(f, memo), k) for k, f in enumerate(r)], train_only)
            sides.append(list(zip(listed, norms)))
        byte = lambda n, k: n >> 8 * k & 255
        reach = lambda n, m: all(byte(n, k) + byte(m, k) >= 2 * max(byte(n, k + 1), byte(m, k + 1)) for k in (0, 2))
        assert any(t == u and reach(n, m) for t, n in sides[0] for u, m in sides[1]), (a, b)
        met += 1
    assert met > 300


def test_members_and_links(spark):
    make = lambda rows: spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    near = R.replace("limits", "really limits")
    got = {r.gold_idx: (r.cls, r.links) for r in O.linked(make([(0, I, "", R), (1, I.upper(), "", R), (2, "Else?", "", "Nothing here.")]), make([(3, I, "", near)]), make([(4, I, "", R)])).collect()}
    assert got == {0: (0, 2), 1: (0, 2), 4: (0, 2), 3: (3, 1), 2: (2, 0)}
    assert all(0.9 < r.cosine <= 1.0 for r in O.pairs(make([(0, I, "", R)]), make([(3, I, "", near)]), make([])).collect())
    assert O.cosine(("a b", "", "c"), ("a b", None, "C"), [1.0] * O.BUCKETS, {}) == 1.0 and O.cosine(("", "", ""), (None, None, None), [1.0] * O.BUCKETS, {}) == 1.0


def test_words_of_many_texts_at_once():
    """Terms of a batch are those of its texts one by one, whatever stands in and around them."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(7)
    parts = ["one", "eno", "abcd", "acbd", "One", "12", "21", "Σ", "οΣ", "Été", "İx", "K", "straße", "漢字", "१", "_", "\x01", "\x00", " ", "\n", ": ", ", ", "—", "'", "{", "}", " "]
    text = lambda: rng.choice([None, "", "".join(rng.choice(parts) for _ in range(rng.randint(1, 40))), "".join(rng.choice(parts[:7] + parts[16:20]) for _ in range(30))])
    rows = [[text() for _ in O.FIELDS] for _ in range(700)] + [["a Σ", "Σ b", "\x01"], ["", None, "\x01\x01"]]
    numbers = O._Numbers()
    for part in (rows[:300], rows[300:]):
        place, h, t = O._terms([pa.array([r[k] for r in part], pa.string()) for k in range(3)], numbers)
        for i, r in enumerate(part):
            for k, x in enumerate(r):
                at = np.flatnonzero(place == 3 * i + k)
                hs = O.hashes(x, {})
                assert sorted(h[at].tolist()) == sorted(hs) and sorted(t[at].tolist()) == sorted(O.tokens(hs, k))


def test_lists_of_many_records_at_once():
    """Records have the same lists alone and in a batch, those with few, many and no words."""
    import numpy as np

    rng = random.Random(3)
    known = O.Terms([rng.choice([1.0, 1.5, 4.0]) for _ in range(O.BUCKETS)], [rng.getrandbits(64) for _ in range(O.BUCKETS)])
    rows = [[[f"w{rng.randrange(300)}" for _ in range(rng.choice([0, 1, 3, 5, 9, 60, 200]))] for _ in O.FIELDS] for _ in range(200)]
    weighted = [[known(O.hashes(" ".join(f), {}), k) for k, f in enumerate(r)] for r in rows]
    train_only = np.array([rng.random() < 0.5 for _ in rows])
    flat = [f for r in weighted for f in r]
    place = np.repeat(np.arange(len(flat)), [len(f[0]) for f in flat])
    at, listed, norms, may = O._lists(place, tuple(map(np.concatenate, zip(*flat))), train_only)
    for i, (r, f) in enumerate(zip(rows, weighted)):
        mine = np.flatnonzero(at == i)
        assert sorted(zip(listed[mine].tolist(), norms[mine].tolist())) == sorted(zip(*O.terms(f, train_only[i])))
        assert may[i] == sum(O.allowed(len(x)) for x in r)
    assert {len(O.terms(f, False)[0]) for f in weighted} >= {1, 4}


def test_the_store_of_words_is_emptied(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(O, "HELD", 50)
    numbers = O._Numbers()
    for n in range(9):
        text = " ".join(f"word{n}{k} shared{k}" for k in range(20 + n))
        _, h, t = O._terms([pa.array([text])] * 3, numbers)
        hs = O.hashes(text, {})
        assert sorted(h.tolist()) == sorted(hs * 3) and set(t.tolist()) == {x for k in range(3) for x in O.tokens(hs, k)}
    assert len(numbers) < 300 and len(numbers.hashes()) == len(numbers.of) and np.all(numbers.hashes() > 0)

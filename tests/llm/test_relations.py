import random

import pytest
from pyspark.sql import functions as F

from lodestone.llm import relations as R
from lodestone.llm.components import components

P1 = "It took 40 hours until the ferry was stable again. The people of Ulmen say that the kiln is rare. Nobody expected that the bridge would hold over three seasons."
P2 = "Of 93 samples, 30 suggest that the loom is bright. In Tarn, the mill was quiet for 12 days. The ledger is crowded and narrow, so the canal supports it."


@pytest.mark.parametrize(
    "context, key",
    [
        (f"Author: Anna BELL\n{P1}", "ANNA|BELL"), (f"By Anna Bell\n\n{P1}", "ANNA|BELL"), (f"{P1} (written by Anna Bell)", "ANNA|BELL"), (f"{P1}\n\nText © Anna  Bell", "ANNA|BELL"), (f"{P1}\n— Anna Bell", "ANNA|BELL"),
        (f"[Bell, Anna] {P1}", "ANNA|BELL"), (f"BELL, Anna: {P1}", "ANNA|BELL"), (f"Source: Old Tarn Review, no. 12\n{P1}", "OLDTARNREVIEW"), (f"{P1}\nFirst printed in THE TARN POST, p. 7", "THETARNPOST"),
        (f"{P1}\n(from Old Tarn Review)", "OLDTARNREVIEW"), (f'Excerpt from "Old Tarn Review". {P1}', "OLDTARNREVIEW"), (f"Old Tarn Review | {P1}", "OLDTARNREVIEW"),
    ],
)
def test_credits(context, key):
    body, found = R.credits(context)
    assert [k for _, k, _ in found] == [key] and R._W.findall(body) == R._W.findall(P1)


def test_two_credits_and_none():
    assert [k for _, k, _ in R.credits(f'Excerpt from "Old Tarn Review". By Anna Bell\n\n{P1}')[1]] == ["OLDTARNREVIEW", "ANNA|BELL"]
    assert R.credits(P1) == (P1, []) and R.credits("") == ("", [])
    assert R.credits("By late afternoon, the kiln was cold.")[1] == []


def groups(df):
    return sorted((r.group_idx, r.rec_idx) for r in R.related(df).collect())


def test_related_rows_and_chains(raw):
    reworded = P1.replace("stable", "sturdy").replace("kiln is", "kiln indeed is")
    df = raw(
        {"context": P1}, {"context": f"{reworded}\n— Anna Bell"}, {"context": f"Author: Anna Bell\n{P2}"}, {"category": "qa/Zorn"}, {"category": "QA: ZORN", "context": P2.upper()},
        {"context": "By Otto Bell\n\nSomething else was said here by someone."}, {"category": "qa"}, {"category": "qa"}, {"context": "short"}, {"context": "short"},
    )
    assert groups(df) == [(0, 1), (0, 2), (0, 3), (0, 4)]


def test_uncertain_names_need_a_certain_one(raw):
    bodies = ["One thing leads to another thing in this town.", "Nothing of that kind was seen at the gate.", "Five boats came up the river before noon.", "Who would keep bees on such a narrow roof?"]
    heads = ["By Late Afternoon", "By Late Afternoon", "By Ida Holm", "Author: Ida Holm"]
    assert groups(raw(*[{"context": f"{h}\n{b}"} for h, b in zip(heads, bodies)])) == [(2, 3)]


def test_defined_cases(raw):
    df = raw({}, {"context": " "}, {"context": P1}, {"context": P1}, hub=F.lit(1), root=F.lit("r"), idx=F.lit("i"), key=F.lit("k"))
    assert groups(df) == [(2, 3)]
    assert groups(raw()) == []
    assert groups(raw({"context": f"{P1} {'word ' * 50_000}"}, {"context": f"{P1} {'word ' * 50_000}"})) == [(0, 1)]


def test_components_against_brute_force(spark):
    rng = random.Random(9)
    for edges in ([(i, i + 1) for i in range(200)], [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(7, 7)], [(0, i) for i in range(1, 120)], []):
        root = {}

        def top(v):
            while root.setdefault(v, v) != v:
                v = root[v]
            return v

        for a, b in edges:
            root[top(a)] = top(b)
        want, got = {}, {}
        for v in list(root):
            want.setdefault(top(v), set()).add(v)
        for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect():
            got.setdefault(r.root, set()).add(r.v)
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_differencing():
    rng = random.Random(2)
    weights = {f"a{i}": rng.choice([1, 2, 5, 40]) for i in range(500)}
    bins = R.difference(weights, 20)
    sums = [w for w, _ in bins]
    assert sorted(a for _, x in bins for a in x) == sorted(weights) and max(sums) - min(sums) <= 5
    assert all(w == sum(weights[a] for a in x) for w, x in bins) and R.difference({}, 3) == [(0, [])] * 3


def test_splits_keep_groups(spark, small):
    df, targets = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("raw_instructions", "split_targets"))
    place = {r.rec_idx: r.split_name for r in R.splits(df, targets).collect()}
    assert len(place) == df.count()
    assert all(place[r.group_idx] == place[r.rec_idx] for r in R.related(df).collect())
    for r in R.split_shares(df, targets).collect():
        assert abs(r.share - r.target_share) < 0.05


def test_passages_behind_an_unrelated_first_holder(spark):
    """All pairs, where one shared sentence holds most of every passage's shingles and its first holder is unrelated."""
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("abdegiklmnoprstuvz") for _ in range(6))
    shared = [name() for _ in range(30)]
    texts = [[*shared, *(name() for _ in range(14))]]
    for _ in range(20):
        body = [*shared, *(name() for _ in range(20))]
        other = list(body)
        for k in range(32, len(body), 5):
            other[k] = name()
        texts += [body, other]
    words = [(i, " ".join(t)) for i, t in enumerate(texts)]
    grams = [R.Counter(zip(t, t[1:])) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i) if 2 * (grams[i] & grams[j]).total() >= R.SIMILAR * (grams[i].total() + grams[j].total())}
    got = {(r.a, r.b) for r in R.similar_passages(spark.createDataFrame(words, "pid bigint, body string")).collect()}
    assert len(want) >= 20 and got == want


def test_passages_that_stand_at_the_end_of_a_longer_one(spark, raw):
    """40 pairs one word apart, each behind a longer passage that begins with the first of the two."""
    rng = random.Random(11)
    name = lambda: "".join(rng.choice("abdegiklmnoprstuvz") for _ in range(6))
    rows = []
    for _ in range(40):
        body = [name() for _ in range(20)]
        other = list(body)
        other[10] = name()
        rows += [" ".join([*body, *(name() for _ in range(20))]), " ".join(body), " ".join(other)]
    got = {(r.group_idx, r.rec_idx) for r in R.related(raw(*[{"context": c} for c in rows])).collect()}
    assert got == {(3 * k + 1, 3 * k + 2) for k in range(40)}


def test_too_many_splits_are_an_error(spark, raw):
    targets = spark.createDataFrame([(f"s{i}", 0.001) for i in range(R.MAX_TARGETS + 1)], "split_name string, target_share double")
    with pytest.raises(ValueError):
        R.splits(raw({"context": "a b c d e"}), targets)
    few = spark.createDataFrame([("a", 0.5), ("a", 0.3), ("b", 0.2), (None, 1.0)], "split_name string, target_share double")
    place = [r.split_name for r in R.splits(raw(*[{"context": f"text number {i} of many texts"} for i in range(50)]), few).collect()]
    assert len(place) == 50 and set(place) == {"a", "b"} and place.count("a") > place.count("b")

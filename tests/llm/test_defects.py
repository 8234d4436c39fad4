import pytest
from pyspark.sql import functions as F

from lodestone.llm import defects as D
from lodestone.llm import languages as L

LONG = "The kiln needs 47 steps, while the bridge is already narrow. Nobody expected that the ferry would stay stable over three seasons."
ES = "La gente de Ulm dice que el coro es notable. Nadie esperaba que la medición fuera tan útil durante el invierno."
ASK = "Who decided that the kiln of Ulm should be bright, and was it in early spring?"


@pytest.mark.parametrize(
    "ask, answer, defect",
    [
        (ASK, LONG, None), (ASK, None, "empty"), (ASK, " \u200b", "empty"), (ASK, "(N/A)", "empty"), (ASK, "yes", None), (ASK, LONG + " And the", "truncated"), (ASK, "I'm sorry, but I can't help with that request.", "refusal"),
        (ASK, "Sorry, I can't provide that. You may want to consult the Ulm office.", "refusal"), (ASK, '"I can\'t help you with that," said the keeper of Ulm, and shut the door. ' + LONG, None), (ASK, "I'm sorry, but I cannot come to the feast in Ulm this year. " + LONG, None),
        (ASK, ASK.lower(), "copy"), (ASK, ASK + " " + LONG, None), (ASK, ES, "language"), ("Translate into Spanish, for the Ulm brochure: " + LONG, ES, None), ("¿Quién decidió que el horno de Ulm es notable y por qué?", "Es tut mir leid, aber dabei kann ich nicht helfen.", "refusal"),
        (None, LONG, None), ("Rewrite this line from Ulm in a friendlier tone: " + LONG, LONG.replace("narrow", "slim"), None),
    ],
)
def test_defects(raw, log, ask, answer, defect):
    got = D.defects(raw({"instruction": ask, "response": answer}), log()).collect()
    assert [r.defect for r in got] == ([defect] if defect else [])


def test_defined_cases(raw, log):
    df = raw({"instruction": ASK, "response": "n/a"}, {"instruction": ASK, "response": LONG * 2000}, {"instruction": ASK, "response": ES * 1000}, defect=F.lit(1), cut=F.lit("x"), rec_idx=F.lit(9), text=F.lit("t"))
    assert sorted((r.rec_idx, r.defect) for r in D.defects(df.unionByName(df), log()).collect()) == [(0, "empty")] * 2 + [(2, "language")] * 2
    assert D.defects(raw(), log()).count() == 0


def test_field_is_fitted_and_decoded_consistently():
    pairs = [D.Pair(ASK, t, False) for t in (LONG, ES, "I cannot comply with this request. You may want to consult the Ulm office.", ASK)] + [D.Pair(ASK, LONG + " And the", True)]
    labels = [[0, 0], [3, 3], [1, 1], [2], [0, 0, 4]]
    assert D.decode(pairs) == labels
    emit, move = D.fit(pairs * 5, labels * 5, rounds=80)
    assert emit.shape == (5, len(D.FEATURES)) and move.shape == (5, 5)
    assert D.decode([D.Pair("", "", False)]) == [[]]


def test_viterbi_against_brute_force():
    import itertools

    emit, move = D.weights()
    p = D.Pair(ASK, "I cannot comply with this request. " + LONG, False)
    score = lambda y: sum(emit[t] @ [float(v) for v in f] for t, f in zip(y, p.features)) + sum(move[a, b] for a, b in zip(y, y[1:]))
    assert tuple(D.decode([p])[0]) == max(itertools.product(range(5), repeat=len(p.features)), key=score)


def test_labels_come_from_the_corpus(small):
    """Held-out rows: whole responses that many unlike questions share are refusals, without any list of phrases."""
    import pyarrow.parquet as pq

    from lodestone.llm import fit_defects as fit

    big = small.replace("sf0.001", "sf0.1")
    table = pq.read_table(f"{big}/raw_instructions.parquet", columns=["instruction", "context", "response"]).slice(0, 12_000)
    rows = [r for r in table.to_pylist() if not D.is_empty(r["response"]) and D.truncation.inspect(r["response"])[0] != "cut"]
    pairs = [D.Pair(r["instruction"], r["response"], False, r["context"]) for r in rows]
    found = [D.defect_of(p, t) for p, t in zip(pairs, D.decode(pairs))]
    same = [fit.copied(r) for r in rows]
    marked = [d for d, s, c in zip(found, fit.stock(rows), same) if s and not c]
    assert len(marked) > 20 and sum(d == "refusal" for d in marked) / len(marked) > 0.95
    assert sum(d == "copy" for d, c in zip(found, same) if c) > 0.9 * sum(same) > 0
    own = [(r, d) for r, d in zip(rows, found) if not D._ASKS_LANGUAGE.search(r["instruction"].lower())]
    other = [d for r, d in own if (a := fit.spoken(D._words(r["instruction"]))) and (b := fit.spoken(D._words(r["response"]))) and a != b and d != "refusal" and "```" not in r["response"] and len(r["response"]) > 60]
    assert sum(d == "language" for d in other) > 0.9 * len(other)


@pytest.mark.parametrize(
    "ask, answer, defect",
    [
        (ASK, "Selon le rapport, la vieille maison a été vendue et personne ne pensait que le travail serait si long.", "language"),
        (ASK, "Secondo il rapporto la vecchia casa è stata venduta, e nessuno pensava che il lavoro sarebbe stato così lungo.", "language"),
        (ASK, "Według raportu stary dom został sprzedany, a nikt nie myślał, że praca będzie tak długa.", "language"),
        (ASK, "По данным отчёта старый дом был продан, и никто не ожидал этого.", "language"),
        ("Translate this into Italian: the old house was sold.", "La vecchia casa è stata venduta e nessuno lo sapeva.", None),
        (ASK, "I would rather not answer this question, sorry.", "refusal"),
        (ASK, "No puedo responder a esta pregunta.", "refusal"),
        ("Rewrite this line in a friendlier tone: " + LONG, "The kiln needs 47 steps, while the bridge is already slim. Nobody expected that the ferry would stay stable over three seasons.", None),
        (ASK, "Ulm, Ulm, Ulm.", None), ("x" * 5000 + " " + ASK, "x" * 5000 + " " + ASK, "copy"),
    ],
)
def test_further_defects(raw, log, ask, answer, defect):
    got = D.defects(raw({"instruction": ask, "response": answer}), log()).collect()
    assert [r.defect for r in got] == ([defect] if defect else [])


def test_profiles_of_languages():
    for line in (D.Path(D.__file__).with_name("languages.txt")).read_text(encoding="utf-8").splitlines():
        name, _, text = line.partition("\t")
        for sentence in text.split(". "):
            assert L.language(D._words(sentence)) == name, sentence
    assert L.language(["praise"]) is None and L.language([]) is None and L.language(["12", "34"]) is None
    assert L.script("Привет, мир") == "CYRILLIC" and L.script("日本語の文章") and L.script("Zürich") is None and L.script("") is None

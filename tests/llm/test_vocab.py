import base64
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.llm import encode, mixing
from lodestone.llm.vocab import PerfectHash, Vocabulary, default_path, pre_tokens

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DOCS = "doc_id bigint, text string, source string"


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary.load()


@pytest.fixture(scope="module")
def other():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(default_path(), "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash():
    rng = random.Random(1)
    items = {rng.randbytes(rng.randint(1, 9)): i for i in range(5000)}
    h = PerfectHash(items)
    assert h.n == len(items) == len(h.keys) and None not in h.keys
    assert all(h.get(k) == v for k, v in items.items()) and h.get(b"not there at all") is None
    assert PerfectHash({}).get(b"x") is None


TEXTS = ["", " ", "\n\n\nx", "don't we'll 12 34", "<|endoftext|>", "naïve façade", "日本語の文章です。" * 30, "\x1c\x1d\x1e\x1f a", "a\u00a0\u2003b\u3000 c", "👩‍👩‍👧 e\u0301", "A" * 3000, "\t \t", "x\r\ny", "١٢٣ ²"]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_another_encoder(vocab, other, text):
    assert vocab.encode(text) == other.encode_ordinary(text) and vocab.count(text) == len(vocab.encode(text))
    assert "".join(pre_tokens(text)) == text


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_equals_another_encoder_on_any_text(vocab, other, text):
    assert vocab.encode(text) == other.encode_ordinary(text)


def test_ids_of_documents(spark, small, other):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r.ids for r in encode.token_ids(docs).collect()}
    assert got == {r.doc_id: other.encode_ordinary(r.text or "") for r in docs.collect()}
    odd = spark.createDataFrame([(1, None, None), (2, "", None), (2, "", None)], DOCS).withColumn("ids", F.lit("clash"))
    assert [r.ids for r in encode.token_ids(odd).collect()] == [[], [], []]
    assert encode.token_ids(odd.limit(0)).count() == 0


@pytest.mark.parametrize("most, overlap", [(300, 40), (400, 0)])
def test_pieces(spark, vocab, most, overlap):
    rng = random.Random(most)
    words = ["kiln", "ferry", "Zürich", "supercalifragilistic", "12", "日本語", "end."]
    texts = ["", None, "short", " ".join(rng.choice(words) for _ in range(1500)), "日本語の文章" * 400, "\n\n".join("A sentence here. Another one follows. " * 9 for _ in range(12)), "x" * 5000, " " * 3000]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], DOCS).withColumn("piece_no", F.lit("clash"))
    got = {}
    for r in encode.pieces(docs, most, overlap).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {i for i, t in enumerate(texts) if t and vocab.count(t) > most}
    for i, rows in got.items():
        rows.sort(key=lambda r: r.piece_no)
        at = 0
        for r in rows:
            assert texts[i][r.start_char : r.end_char] == r.piece and vocab.count(r.piece) <= most
            assert r.start_char <= at < r.end_char and vocab.count(texts[i][r.start_char : at]) <= max(overlap, 1)
            at = r.end_char
        assert at == len(texts[i]) and rows[0].start_char == 0
    assert all(r.piece.rstrip().endswith(".") for r in got[5])
    with pytest.raises(ValueError):
        encode.pieces(docs, 100, 99)


def test_flight_keeps_totals():
    rng = random.Random(5)
    tokens = [rng.randint(1, 500) for _ in range(700)]
    p = mixing.flight(tokens, [0.3] * 700, random.Random(1))
    assert sum(0 < x < 1 for x in p) <= 2
    assert abs(sum(p) - 210) < 1e-6 and abs(sum(t * x for t, x in zip(tokens, p)) - 0.3 * sum(tokens)) < 1e-3
    done = mixing.landing(tokens, p)
    assert set(done) <= {0.0, 1.0} and abs(sum(t * x for t, x in zip(tokens, done)) - 0.3 * sum(tokens)) <= 500
    assert mixing.flight([5, 5, 5], [0.5, 0.5, 0.5], random.Random(1)).count(0.5) <= 1


def test_mixture(spark):
    docs = [(i, "word " * (5 + i % 7), "a") for i in range(4500)] + [(5000 + i, "tiny bit", "b") for i in range(10)] + [(6000, None, "a"), (6001, "loose text", None), (6002, "", "c")]
    df = spark.createDataFrame(docs, DOCS).withColumn("n_tokens", F.lit("clash")).withColumn("uses", F.lit(1))
    goal = spark.createDataFrame([("a", 0.6, 2, 1.0), ("b", 0.4, 3, 1.0), ("none", 0.1, 1, 1.0), ("c", None, None, 1.0)], "source string, target_share double, max_uses bigint, budget_fraction double")
    r = {x.source: x for x in mixing.report(df, goal).collect()}
    assert r["b"].short and r["b"].got_docs == 30 and r["none"].short and r["none"].got_tokens == 0 and not r["c"].short
    assert not r["a"].short and abs(r["a"].got_tokens - r["a"].owed_tokens) < 30
    again = {x.source: x for x in mixing.report(df.repartition(5), goal).collect()}
    assert again == r
    uses = mixing.mix(df, goal)[0].collect()
    assert all(u.uses <= {"a": 2, "b": 3, "c": 0}[u.source] for u in uses)
    assert mixing.report(df.limit(0), goal).where("got_tokens > 0").count() == 0

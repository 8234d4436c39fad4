import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.config import DataConfig
from lodestone.functions.text import WS, canonical_text, clean_text, lcs_length, normalize_answer, overlap, strip
from lodestone.operators import records as R

GOOD = [(0, "a", "What is a kiln?", "", "An oven for clay.", "qa"), (1, "b", "Name a colour of the sky", "", "Blue.", ""), (2, "c", "Say a word that rhymes", "x", "Time.", "qa")]
BAD = [(3, "d", "What is a  KILN?", None, "an oven for clay. ", "qa"), (4, "e", "Tell me something now", "", "", "qa"), (5, "f", "Echo this sentence", "", "echo this sentence", "qa"), (6, "g", "Hi", "", "Hello there", "qa")]


def messy(spark, schema):
    return R.normalize(spark.createDataFrame(GOOD + BAD, schema), "t")


def test_clean_text(spark):
    rows = [("a\r\nb\rc",), ("a \t b",), ("a\n\n\n\nb",), ("  x \x1c",), (None,), ("",), ("\n \n \n",), ("x\n \n \ny",)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(clean_text(F.col("x"))).collect()]
    assert got == ["a\nb\nc", "a b", "a\n\nb", "x", "", "", "", "x\n \n \ny"]


def test_strip_equals_python(spark):
    chars = [chr(c) for c in (*range(0x21), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
    df = spark.createDataFrame([(f"{c}x{c}",) for c in chars], "x string")
    for x, y in df.select("x", strip(F.col("x"))).collect():
        assert y == x.strip(), ascii(x)
    assert WS


def test_canonical_keeps_line_ends(spark):
    row = spark.createDataFrame([(" A \t B\nC ",)], "x string").select(canonical_text(F.col("x"))).first()
    assert row[0] == "a b\nc"


def test_normalize_aliases_and_ids(spark):
    df = spark.createDataFrame([(7, "q?", "", "the answer", 3), (1234567, "q?", None, "the answer", 4)], "_idx bigint, question string, input string, answer string, score int")
    a, b = R.normalize(df, "src").orderBy("_idx").collect()
    assert (a.instruction, a.context, a.response, a.category) == ("q?", "", "the answer", "")
    head = hashlib.sha1(b"src|q?|the answer").hexdigest()[:12]
    assert (a.id, b.id) == (f"{head}-000007", f"{head}-1234567")
    assert a.meta == '{"score":3}'


def test_messy_corpus(spark, records_schema):
    j = R.judged(messy(spark, records_schema)).cache()
    assert {r.reason: r.n for r in R.drop_counts(j).collect()} == {"duplicate": 1, "response_missing": 1, "response_echoes_instruction": 1, "instruction_too_short": 1}
    s = R.validation_summary(j).first()
    assert (s.input, s.kept, s.dropped, s.is_healthy) == (7, 3, 4, False)
    assert R.kept(messy(spark, records_schema), DataConfig(dedupe=False)).count() == 4
    assert [r._idx for r in R.dropped_examples(j).collect()] == [4, 5, 6]
    R.assert_unique_ids(messy(spark, records_schema))


def test_control_characters_and_order_of_rules(spark, records_schema):
    rows = [(0, "a", "A fine instruction", "", "ok\x07bell", ""), (1, "b", "", "", "", "")]
    got = [r.reason for r in R.judged(spark.createDataFrame(rows, records_schema)).orderBy("_idx").collect()]
    assert got == ["contains_control_chars", "instruction_missing"]


def test_empty_table(spark, records_schema):
    e = R.normalize(spark.createDataFrame([], records_schema), "t")
    assert R.validation_summary(R.judged(e)).first().keep_rate == 0.0
    assert R.fingerprint(R.with_hash(e)).first().content_hash == hashlib.sha256().hexdigest()
    assert [r.n for r in R.split_sizes(R.assign_split(R.with_hash(e))).collect()] == [0, 0, 0]


def test_split_is_stable_under_growth_and_order(spark, records_schema):
    rows = [(i, f"r{i}", f"Instruction number {i}", "", f"answer {i}", "c") for i in range(300)]
    place = lambda r: {x.id: x.split for x in R.assign_split(R.kept(R.normalize(spark.createDataFrame(r, records_schema), "t"))).collect()}
    shuffled = rows[:200]
    random.Random(1).shuffle(shuffled)
    a, b, c = place(rows[:200]), place(shuffled), place(rows)
    assert a == b and all(c[k] == v for k, v in a.items())
    other = {x.id: x.split for x in R.assign_split(R.kept(R.normalize(spark.createDataFrame(rows, records_schema), "t")), DataConfig(version="v2")).collect()}
    assert other != c


def test_bucket_equals_python(spark):
    h = hashlib.sha256(b"x").hexdigest()
    got = spark.createDataFrame([(h,)], "h string").select(R.bucket("v1.0:42", F.col("h"))).first()[0]
    assert got == int(hashlib.sha256(f"v1.0:42|{h}".encode()).hexdigest()[:8], 16) % 10000


def test_fingerprint_ignores_order(spark, records_schema):
    df = R.with_hash(messy(spark, records_schema))
    digests = sorted(r.content_hash for r in df.collect())
    want = hashlib.sha256("".join(digests).encode()).hexdigest()
    assert R.multiset_hash(df) == (want, 7) == R.multiset_hash(df.orderBy(F.desc("_idx")).repartition(5))


def test_positions(spark):
    df = spark.createDataFrame([(x,) for x in random.Random(3).sample(range(1000), 200)], "v int").repartition(7)
    got = R.positions(df, ["v"]).orderBy("v").collect()
    assert [r._idx for r in got] == list(range(200))


def test_leakage(spark):
    df = spark.createDataFrame([("h1", "train"), ("h1", "test"), ("h2", "validation"), ("h2", "test")], "content_hash string, split string")
    assert [r[0] for r in R.leaked(df).collect()] == ["h1"]


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.lists(st.sampled_from("abcde"), max_size=70), st.lists(st.sampled_from("abcde"), max_size=70))
@settings(max_examples=200, deadline=None)
def test_lcs_and_overlap(a, b):
    assert lcs_length(a, b) == brute_lcs(a, b)
    assert overlap(a, b) == sum(min(a.count(c), b.count(c)) for c in "abcde")


def test_normalize_answer(spark):
    rows = [("The  Cat, a-b don't!",), ("“the cat",), ("an a the",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(normalize_answer(F.col("x"))).collect()]
    assert got == ["cat ab dont", "“ cat", "", ""]

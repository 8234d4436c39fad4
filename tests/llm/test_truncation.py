import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.llm import truncation as T


@pytest.mark.parametrize(
    "text, verdict",
    [
        ("A whole sentence. And one more.", "whole"), ("A whole sentence. And one mo", "cut"), ('He said "so it is."', "whole"), ("First, then,", "cut"), ('{"a": "b", "c": [1, 2]}', "whole"), ('{"a": "b", "c', "cut"),
        ('{"a": "}', "cut"), ("```python\nx = 1\n```", "whole"), ("```python\nx = 1", "cut"), ("def f(x:\n    return max(x", "cut"), ("", "missing"), (None, "missing"), (" \u200b\n", "missing"), ("…", "missing"), ("Text ends badly �", "cut"),
        ("- one thing\n- ", "cut"), ("One. Two.\n— Anna Bell", "whole"), ("The kiln needs a", "open"), ("yes", "open"), ("Year: 1850\nPla", "cut"), ("Year: 1850\nPlace: Ulm", "whole"), ("Ends here。", "whole"), ("Really?!", "whole"),
    ],
)
def test_verdicts(text, verdict):
    got = T.inspect(text)[0]
    assert got == verdict or (text == "The kiln needs a" and got in ("open", "cut"))


def test_natural_ends_settle_lists(raw, log):
    whole = "- a cup of tea at low tide\n- a second cup at low tide\n- soup before noon\n- bread before noon\n- fish at low tide"
    df = raw({"response": whole}, {"response": whole.replace("soup", "rice")}, {"response": "- soup before noon\n- fish at lo"}, {"response": "- soup before noon\n- fish at low tide"})
    got = {(r.field_name, r.row_key) for r in T.truncated(df, log("A sentence that stops in the mi", "Done. All done.")).collect()}
    assert got == {("response", 2), ("prediction", 0)}


def test_dots(raw, log):
    said = [f"Number {w} ends here. To be continued..." for w in ("one", "two", "three")]
    cut = ["The cup was full. The kettle was still...", "The kettle was hot. The kettle was off. The kettle was new. The ket..."]
    got = {r.row_key for r in T.truncated(raw(), log(*said, *cut)).where("field_name = 'prediction'").collect()}
    assert got == {3, 4}


def test_stubs_of_longer_copies(raw, log):
    df = raw(*[{"response": "complaint"}] * 3, {"response": "compla"}, {"response": "praise"}, {"response": "complaint."})
    assert [r.row_key for r in T.truncated(df, log()).collect()] == [3]


def test_defined_cases(raw, log):
    df = raw({"response": None}, {"response": ""}, {"response": "Long. " * 100_000 + "And the en"}, {"response": "Long. " * 100_000}, text=F.lit(1), tail=F.lit("x"), seen=F.lit(3), field_name=F.lit("f"))
    assert [r.row_key for r in T.truncated(df, log()).collect()] == [2]
    assert T.truncated(raw(), log()).count() == 0
    assert [r.row_key for r in T.truncated(df.unionByName(df), log()).collect()] == [2, 2]
    s = {(r.field_name, r.origin): (r["values"], r.cut, r.cut_share) for r in T.share_by_origin(df, log("Whole. Yes.", "Whole. N")).collect()}
    assert s == {("response", None): (2, 1, 0.5), ("prediction", "m"): (2, 1, 0.5)}


@pytest.mark.parametrize("parts", [1, 7])
def test_strict_prefixes_against_brute_force(spark, parts):
    import random

    rng = random.Random(parts)
    texts = ["".join(rng.choice("AB") for _ in range(rng.randint(0, 7))) for _ in range(150)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    got = {r.norm for r in T.strict_prefixes(spark.createDataFrame([(t,) for t in texts], "norm string")).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {t for t in texts if t and any(u != t and u.startswith(t) for u in texts)}


@given(st.text(max_size=300))
@settings(max_examples=300, deadline=None)
def test_any_text_has_a_verdict(text):
    verdict, tail, shown = T.inspect(text)
    assert verdict in (T.CUT, T.WHOLE, T.OPEN, T.MISSING) and (verdict != T.OPEN or tail is not None)


def test_stubs_delivered_again(raw, log):
    df = raw(
        *[{"response": "complaint"}] * 3, *[{"response": "compla"}] * 2, {"response": "The kiln"}, *[{"id": "r1", "response": "The kil"}] * 2,
        *[{"response": "pregunta"}] * 3, {"response": "preguntas"}, {"response": "refund"}, {"response": "refund request"},
    )
    assert sorted(r.row_key for r in T.truncated(df, log()).collect()) == [3, 4, 6, 7]

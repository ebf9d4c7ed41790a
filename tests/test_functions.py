import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.functions import labels as L
from scriptorium.functions import text as X
from scriptorium.functions import transliteration as T


def one(spark, values, *exprs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [tuple(r)[1:] for r in df.select("i", *[e.alias(f"c{k}") for k, e in enumerate(exprs)]).orderBy("i").collect()]


# Pairs of the kind the rules were made for.
WORDS = [
    ("kåñṇa", "kṛṣṇa"), ("KÅÑṆA", "KṚṢṆA"), ("Kåñṇa", "Kṛṣṇa"), ("viñṇu", "viṣṇu"), ("jñāna", "jñāna"), ("Bhagavån", "Bhagavān"), ("småti", "smṛti"), ("dhåti", "dhṛti"), ("bhågu", "bhṛgu"), ("hådaya", "hṛdaya"), ("pañca", "pañca"), ("vrajåñja", "vrajṛṣja"), ("plain", "plain"), ("", ""), (None, None)
]


def test_words(spark):
    got = one(spark, [a for a, _ in WORDS], T.fix_text(F.col("v")))
    assert [g[0] for g in got] == [b for _, b in WORDS]


def test_mixed_case_and_rest(spark):
    got = one(spark, ["viÑṇU", "Verses 1-18, kåñṇa!\nnext", "x" * 20_000 + " kåñṇa"], T.fix_text(F.col("v")))
    assert got[0][0] == "viṢṇU" and got[1][0] == "Verses 1-18, kṛṣṇa!\nnext" and got[2][0].endswith(" kṛṣṇa")


def row(w):
    """The word rules, one word at a time."""
    import re

    s = w.replace("jñ", "\x01").replace("ñc", "\x02")
    s = re.sub("([aāiīuūṛeēoō])ñj", "\\1\x03", s).replace("ñ", "ṣ").replace("\x01", "jñ").replace("\x02", "ñc").replace("\x03", "ñj")
    for a, b in T.A_RULES:
        s = re.sub(a, b.replace("$", "\\"), s)
    return s


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("aāiīuñåjcktdhbgvrmpsśṇḍ", max_size=9), min_size=30, max_size=60))
def test_rules_match_row_interpreter(spark, words):
    got = one(spark, words, T.fix_a(T.fix_n(F.col("v"))))
    assert [g[0] for g in got] == [row(w) for w in words]


def test_case_pattern_and_class(spark):
    got = one(spark, ["abc", "ABC", "Abc", "aBc", "12", "ñå", "ññ", "å-å", "ñ"], T.case_pattern(F.col("v")), T.word_class(F.col("v")))
    assert [g[0] for g in got] == ["lower", "upper", "title", "mixed", "lower", "lower", "lower", "lower", "lower"]
    assert [g[1] for g in got][5:] == ["BOTH", "MULTIPLE_N", "MULTIPLE_A", "SINGLE_N"]


def test_corrections(spark):
    r = {x.word: x for x in T.corrections(spark.createDataFrame([("kåñṇa", 2), ("clean", 1)], "word string, n long")).collect()}
    assert r["clean"].confidence == 1.0 and not r["clean"].error
    assert r["kåñṇa"].corrected == "kāṣṇa" and "ñṇ→ṣṇ" in r["kåñṇa"].tags


RANGES = [("[1,10)", 1, 9), ("[1,10]", 1, 10), ("(1,10)", 1, 9), ("[5,15]", 5, 15), ("[100,200)", 100, 199), ("[1,1]", 1, 1), ("", None, None), (None, None, None), ("invalid", None, None), ("[10,5]", None, None)]


def test_ranges(spark):
    assert one(spark, [r[0] for r in RANGES], *L.range_bounds(F.col("v"))) == [r[1:] for r in RANGES]
    assert [g[0] for g in one(spark, ["3-7", "3,7", "[1,2)", "x", None], L.format_range(F.col("v")))] == ["[3,8)", "[3,8)", "[1,2)", "x", None]


@pytest.mark.parametrize("text,want", [("1 2 3 end", "123"), ("page (xiv)", "xiv"), ("foo 12 bar", "12"), ("", ""), (None, ""), ("nothing here", ""), ("x v i", "xvi")])
def test_labels(spark, text, want):
    assert one(spark, [text], L.label_of(F.col("v")))[0][0] == want


def test_text_measures(spark):
    t = "Copyright 2001. First Edition. ISBN 1. Contact us at a@b.org and www.x.org"
    s, e, c = one(spark, [t], X.publisher_score(F.col("v")), X.empty_page(F.col("v")), X.ending(F.col("v")))[0]
    assert s >= 9 and not e and c == "letter"
    assert [g[0] for g in one(spark, ["", None, " ab ", "long enough"], X.empty_page(F.col("v")))] == [True, True, True, False]
    assert one(spark, ["kåñëa µ"], F.size(X.term_errors(F.col("v"))))[0][0] == 2

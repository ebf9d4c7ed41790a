import unicodedata

import pytest

from pyspark.sql import functions as F

from scriptorium.llm import lookalikes as L


@pytest.mark.parametrize(
    "value,want",
    [
        ("caνonaya", "cavonaya"),
        ("Ｔｏｃｉ", "Toci"),
        ("äbånpéta", unicodedata.normalize("NFC", "äbånpéta")),
        ("kри", "kpи"),
        ("шритика", "шритика"),
        ("шpитика", "шритика"),
        ("क्‍षम", "क्‍षम"),
        ("pa‍­dma rasa", "padma rasa"),
        ("mr̥duvaka", "mr̥duvaka"),
        ("luі̀јa", "luìja"),
        ("a‑b－c", "a-b-c"),
    ],
)
def test_normal(value, want):
    assert L.normal(value) == want
    t = L.Trie()
    t.add(want, 3)
    t.add(want + "x", 9)
    assert t.match(value) == want
    assert L.Trie().match(value) is None


def test_apply_edges(spark):
    rows = [("t", 1, "pad­ma"), ("t", 2, "padma"), ("t", 2, "padma"), ("u", 1, None), ("u", 2, " "), ("u", 3, "​"), ("u", 4, "x" * 5000 + " "), ("u", 5, " padma ")]
    df = spark.createDataFrame(rows, "src_table string, row_id long, value string")
    got = sorted((r.src_table, r.row_id, r.canonical, r.changed) for r in L.apply(df, shards=3).where("row_id <> 4").collect() if r.canonical is not None)
    assert got == [("t", 1, "padma", True), ("t", 2, "padma", False), ("t", 2, "padma", False), ("u", 2, "", False), ("u", 3, "​", False), ("u", 5, "padma", False)]
    long = L.apply(df, shards=3).where("row_id = 4").first()
    assert long.canonical == "x" * 5000 and long.changed
    assert L.apply(df.limit(0)).count() == 0
    assert L.apply(df).count() == len(rows)


def test_other_columns(spark):
    df = spark.createDataFrame([("t", 1, "pa\u200bdma", "x", True)], "src_table string, row_id long, value string, canonical string, changed boolean")
    assert [tuple(r) for r in L.apply(df, shards=2).collect()] == [("t", 1, "pa\u200bdma", "padma", True)]


def test_steps_and_costs():
    t = L.Trie()
    for w, n in (("mokṣa", 9), ("cop", 2), ("сор", 50), ("νoga", 1), ("voga", 7), ("noga", 40)):
        t.add(w, n)
    # Letters that are merely alike: the tables know no such step, the trie does.
    assert t.match("мокṣa") == "mokṣa" != L.normal("мокṣa")
    # The vocabulary says which script a word of look-alikes belongs to.
    assert t.match("сop") == "сор" and L.normal("сop") == "cop"
    # A look-alike costs nothing, one that is merely alike something, however frequent.
    assert t.match("νоga") == "νoga" or t.match("νоga") == "voga"
    # Words of one script are read as they stand; three alike letters are too many.
    assert t.match("mokşa") is None and t.match("mo​kṣa") == "mokṣa"
    t.add("nnnn", 5)
    assert t.match("пппn") is None and t.match("ппnn") == "nnnn"


def test_skeleton_is_kept_by_every_step():
    for a, steps in L.STEPS.items():
        for b, _ in steps:
            assert L.skeleton(a) == L.skeleton(b)
    assert L.skeleton("мо​кṣa") == L.skeleton("mokṣa")


def test_skeleton_on_the_jvm(spark):
    words = ["mokṣa", "Ñandú", "plain", "ǟx", "Ǖ", "hǫ", "co-op", "ýź", "KHMTPX"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", L.skeleton_of(F.col("w"))).collect()
    assert {w: k for w, k in got} == {w: L.skeleton(w) for w in words}


def test_vocabulary_decides(spark):
    rows = [("t", i, v) for i, v in enumerate(["mokṣa"] * 5 + ["сор"] * 9 + ["cop", "мокṣa", "the сop rasa", "хyz", "mokṣa"])]
    got = {r.row_id: (r.canonical, r.changed) for r in L.apply(spark.createDataFrame(rows, "src_table string, row_id long, value string")).collect()}
    assert got[15] == ("mokṣa", True) and got[16] == ("the сор rasa", True) and got[17] == ("xyz", True)
    assert all(not got[i][1] for i in range(15)) and not got[18][1]

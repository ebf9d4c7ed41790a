import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import scans as S

WORDS = "river temple garden teacher morning wisdom journey silence mountain kindness forest answer window village lesson pastime question devotion humility tradition".split()


def page(r, book, n):
    """One page with its noise, and the noise's kinds."""
    kinds = set()
    text = " ".join("The " + " ".join(r.choice(WORDS) for _ in range(8)) + " grows." for _ in range(9)).split()
    lines, line = [], ""
    for w in text:
        if len(line) + len(w) > 52:
            lines.append(line)
            line = ""
        line = (line + " " + w).strip()
    lines.append(line)
    if book == 1:
        if r.random() < 0.5:
            i = r.randrange(len(lines) - 1)
            w, _, rest = lines[i + 1].partition(" ")
            if w in WORDS and len(w) > 5 and rest:
                lines[i] += " " + w[:3] + r.choice("-¬‐")
                lines[i + 1] = w[3:] + " " + rest
                kinds.add("hyphen")
        if r.random() < 0.4:
            i = r.randrange(len(lines))
            if "river" in lines[i]:
                lines[i] = lines[i].replace("river", "r!ver", 1)
                kinds.add("misread")
            elif "garden" in lines[i]:
                lines[i] = lines[i].replace("garden", "garclen", 1)
                kinds.add("misread")
        if r.random() < 0.6:
            lines.insert(0, "The Quiet Mountain of Sorrow")
            kinds.add("header")
        if r.random() < 0.6:
            lines.append(f"— {n} —")
            kinds.add("page_number")
    return "\n".join(lines), kinds


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, ts long, book long, page long, text string")


def test_planted_noise(spark):
    r = random.Random(9)
    rows, want = [], set()
    for i in range(400):
        b = 1 + i % 2
        t, k = page(r, b, i // 2 + 1)
        rows.append((i, 1, b, i // 2 + 1, t))
        want |= {(i, x) for x in k}
    rows += [(900, 1, 3, 1, None), (901, 1, 3, 2, ""), (902, 1, 3, 3, " \n "), (903, 1, None, None, "word " * 20_000), (0, 0, 1, 1, "old r!ver version"), (1, 1, 2, 1, rows[1][4])]
    x = S.Scans(frame(spark, rows))
    got = {(n.id, n.noise) for n in x.noise().collect()}
    for kind in ("hyphen", "misread", "header", "page_number"):
        a, b = {g for g in got if g[1] == kind}, {w for w in want if w[1] == kind}
        assert b and len(a & b) >= 0.9 * max(len(a), len(b)), (kind, len(a), len(b), len(a & b))
    done = {c.id: c.text for c in x.cleaned().collect()}
    assert done[900] is None and done[901] == "" and len(done) == 404
    assert all("r!ver" not in t and "garclen" not in t for i, t in done.items() if t)


def test_empty(spark):
    x = S.Scans(frame(spark, []))
    assert x.noise().count() == 0 and x.cleaned().count() == 0


@pytest.mark.parametrize("line,alone,has", [("— v —", True, True), ("[55]", True, True), ("2 8", True, True), ("Page xii", True, True), ("|| 5 ||", False, False), ("The Song of Hills   22", False, True), ("iv   The Song of Hills", False, True), ("In 1999 the river", False, False)])
def test_page_numbers(line, alone, has):
    assert S.furniture(line)[1:] == (alone, has)


def test_clean():
    t = "The Title   4\nThe r!ver is peace-\nful and well-\nknown.\n\nA new\nday.\n— 4 —"
    assert S.clean(t, {"The Title   4", "— 4 —"}, {"peace\0ful"}, {"r!ver": "river"}) == "The river is peaceful and well-known.\n\nA new day."


def test_word_cut_at_the_end_of_a_page(spark):
    """The word is completed where it begins, and its rest taken off the next page."""
    assert S.clean("Peace and kind-\n— 4 —", {"— 4 —"}, set(), {}, "kind\0ness", None) == "Peace and kindness"
    assert S.clean("The Title\nness grows.", {"The Title"}, set(), {}, None, "ness") == "grows."
    r = random.Random(4)
    rows = [(i, 1, 2, i, page(r, 2, i)[0]) for i in range(60)]
    rows += [(200, 1, 7, 1, "The teacher of the village walks in silence and kind-"), (201, 1, 7, 2, "ness to the temple and the river grows. The garden of the village is a lesson.")]
    x = S.Scans(frame(spark, rows))
    assert (200, "hyphen") in {(n.id, n.noise) for n in x.noise().collect()}
    done = {c.id: c.text for c in x.cleaned().collect()}
    assert done[200].endswith("silence and kindness") and done[201].startswith("to the temple")


def test_models_decide(spark, monkeypatch):
    """Models that always say no leave no running titles, no misread words and few cut words."""
    x = S.Scans(S._pages(spark, "/root/testdata/sf0.01"))

    def kinds():
        return {r.noise: r.n for r in x.noise().groupBy("noise").agg(F.count("*").alias("n")).collect()}

    have = kinds()
    monkeypatch.setattr(S, "Boosted", type("No", (), {"__init__": lambda self, *a, **k: None, "predict": lambda self, x: np.zeros(len(x))}))
    left = kinds()
    assert have["header"] > 100 and have["misread"] > 50 and have["hyphen"] > 50
    assert "header" not in left and "misread" not in left and left["hyphen"] < 0.8 * have["hyphen"]


def test_long_words_and_lines(spark):
    """Neither the length of a word nor of a line keeps it from being looked at."""
    word = "antidisestablishment" * 3
    words = [(word, 300), (word.replace("m", "rn", 1), 2)] + [(w, 30) for w in WORDS]
    got = {r.word: r.correction for r in S.misread(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got[word.replace("m", "rn", 1)] == word
    assert S.furniture("The Song of Hills and " * 20 + "End   22")[2]


def test_misread_word_cut_at_a_line_end(spark):
    r = random.Random(3)
    rows = [(i, 1, 2, i, page(r, 2, i)[0]) for i in range(100)]
    rows += [(200, 1, 2, 200, "The teacher walks in the gar-\nclen of the temple."), (201, 1, 2, 201, "A clen here.\nThe gar-\nclen of the temple.")]
    x = S.Scans(frame(spark, rows))
    assert {(m.id, m.word, m.correction) for m in x.misread_words().collect()} >= {(200, "garclen", "garden"), (201, "garclen", "garden")}
    assert {n.id for n in x.noise().collect() if n.noise == "misread"} >= {200, 201}
    assert {c.id: c.text for c in x.cleaned().collect()}[200] == "The teacher walks in the garden of the temple."


def test_forms_of_a_page():
    assert S.forms_of("a gar-\nclen and\nclen pre-\n4") == {"a", "garclen", "and", "clen", "4"}
    assert S.forms_of("a gar-\nclen and") == {"a", "garclen", "and"}
    assert S.forms_of("well- done") == {"done"}


def test_misread_words_beyond_ascii(spark):
    words = [("śāstrani", 400), ("śāstrarii", 2), ("ātmaniva", 300), ("ātrnaniva", 1), ("āśoḥ", 90), ("āś0ḥ", 1)]
    rows = spark.createDataFrame(words + [(w, 30) for w in WORDS], "word string, n long")
    got = {r.word: r.correction for r in S.misread(rows).collect()}
    assert {w: got.get(w) for w in ("śāstrarii", "ātrnaniva", "āś0ḥ")} == {"śāstrarii": "śāstrani", "ātrnaniva": "ātmaniva", "āś0ḥ": "āśoḥ"}

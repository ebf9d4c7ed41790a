import random

import numpy as np
import pytest

from scriptorium.llm import spam as S
from scriptorium.llm.trees import Bagged, Boosted

PROSE = "The old river carries what the quiet village has forgotten. When the teacher of the valley is heard, the morning opens its door."


SPAM = ("link", "tag", "chain", "labelled", "list", "stuffed", "doorway")


def share(t):
    return sum(v for k, v in zip(S.NAMES, S.features(t)) if k in SPAM)


@pytest.mark.parametrize(
    "text",
    [
        "\n".join(f'<a href="http://shop{i}.example/p/{i}">cheap beads {i}</a>' for i in range(8)),
        "#CheapBeads #BrassLamp " * 20,
        "Tags: beads, lamp, cloth, beads\n" * 8,
        "\n".join(f"Brass Lamp • gold • size L • SKU {i}" for i in range(9)),
        "\n".join(f"Best brass lamp in Town{i}\nbrass lamp shop near Place{i}" for i in range(9)),
        "Cheap brass lamp order now free shipping. Buy brass lamp discount price online. " * 6,
        "brass lamp Oldtown › altar cloth Newtown › temple bells Hightown › " * 8,
    ],
)
def test_spam_shapes(text):
    assert share(text) > 0.62


@pytest.mark.parametrize(
    "text",
    [
        PROSE,
        PROSE + "\n#OneTag #TwoTag\nTags: a, b, c",
        "Contents\n" + "\n".join(f"{i}. Chapter of the sea  {i * 7}" for i in range(20)),
        "Verse Index\n" + "\n".join(f"padma {i}.3 ............ {i * 9}, 12" for i in range(20)),
        "References\n" + "\n".join(f"[{i}] Name, The Song of Town, 19{60 + i}. https://lib.example/r/{i}" for i in range(9)),
        PROSE + "\n" + "padma padma rasa rasa\npadma rasa padma rasa\n" * 6,
        "\n".join(f"term{i} – the word means a {w} that grows." for i, w in enumerate("tree river stone lamp door path".split())),
    ],
)
def test_other_shapes(text):
    assert share(text) < 0.35


def test_edges(spark):
    assert S.features("") == S.features(" \n\t ") == [0.0] * len(S.NAMES)
    r = random.Random(1)
    rows = [(i, ("#CheapBeads #BrassLamp " * r.randrange(5, 30)) if i % 4 == 0 else (PROSE + " ") * r.randrange(1, 9), None if i % 5 == 0 else "h", "x") for i in range(200)]
    rows += [(900, None, "h", "x"), (901, "", "h", "x"), (902, "word " * 60_000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, f string")
    got = {x.doc_id: x.score for x in S.judge(S.page_features(df), df).collect()}
    assert 900 not in got and len(got) == 202 and got[901] < 0.5
    assert {i for i in range(200) if got[i] > 0.5} == {i for i in range(200) if i % 4 == 0}
    assert S.judge(S.page_features(df.limit(0)), df).count() == 0
    assert S.judge(S.page_features(df.where("doc_id % 4 = 1")), df).where("score > 0.5").count() == 0


def test_trees_held_out():
    g = np.random.default_rng(3)
    x = g.normal(size=(3000, 6))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    for m in (Bagged(x[:2000], y[:2000], trees=20, depth=9), Boosted(x[:2000], y[:2000])):
        assert ((m.predict(x[2000:]) > 0.5) == y[2000:]).mean() > 0.85


def test_composites():
    tags, prose = "#CheapBeads #BrassLamp\n" * 200, (PROSE + "\n") * 60
    for want in (0.2, 0.5, 0.8):
        text, got = S.composite(tags, prose, want, True)
        assert abs(got - want) < 0.06 and len(text) < 1.1 * S.LONGEST_PAIR
    assert S.composite("a", "", 0.5, False) == ("", 0.0)


def test_rules_are_silent_or_speak_alone():
    assert S.vote(S.features("#CheapBeads #BrassLamp " * 20)) == 1
    assert S.vote(S.features(PROSE)) == 0
    assert S.vote(S.features("")) == 0
    # Tags after prose: the rules contradict each other, the trees decide.
    assert S.vote(S.features(PROSE + "\n" + "#Tag " * 12)) is None


def test_model_decides(spark, sf, monkeypatch):
    """On mixed pages, which no rule labels, the trees find where half is; a constant doesn't."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pages = S.page_features(docs)
    pages.cache()
    model = S.train(pages, docs)
    x = np.array([S.features(S.composite("#CheapBeads #BrassLamp\n" * 200, (PROSE + "\n") * 60, r, True)[0]) for r in (0.15, 0.25, 0.75, 0.9)])
    p = model.predict(x)
    assert (p[:2] < 0.5).all() and (p[2:] > 0.5).all()
    found = S.judge(pages, docs).where("score > 0.5").count()
    assert found > 0
    monkeypatch.setattr(S, "train", lambda *a, **k: type("Flat", (), {"predict": lambda self, x: np.zeros(len(x))})())
    assert S.judge(pages, docs).where("score > 0.5").count() == 0
    pages.unpersist()

"""Pages of repeated keywords, links, tags or product entries instead of sentences.

Content and link features are taken from whole texts. Several independent labelling rules vote, each
on one measure of the page's words or signs; pages on which they don't contradict each other are
weakly labelled. Bagged decision trees are trained on a bounded sample of those and on composites of
two of them in known proportions, which show where half of a page is. They judge every page, and the
page's odds are smoothed by the spam rate of its host (here: its source).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from ..tables import load
from .trees import Bagged

SAMPLE = 4_000  # labelled pages of each class that the trees are trained on, at most
SMOOTH = 0.5  # weight of the host's log-odds
PRIOR = 20.0  # pages that a host's rate is shrunk by
PAIRS = 1_500  # composites of a spam page and another that the trees are trained on, at most
LONGEST_PAIR = 8_000  # characters of a composite

_URL = re.compile(r"<a\s[^>]*>|</a>|\]\(|https?://[^\s)>\"]+|www\.[^\s)>\"]+")
_END = re.compile(r"[.?!।…][\"'”’»)\]]*\s*$")
_REF = re.compile(r"^\s*(?:\[\d+\]|\d+[.)])\s.*\b(?:1[5-9]|20)\d\d\b")
_ENTRY = re.compile(r"(?:\.{3,}|\s{2,}|\t)\s*\d+(?:\s*[,–-]\s*\d+)*\s*$|^\s*\d+[.)]\s")
_GLOSS = re.compile(r"^[^.,:;–—]{1,60}\s[–—-]\s\S")
_LABEL = re.compile(r"^\s*[^\W\d_]+(?: [^\W\d_]+)?:\s")
_CUT = re.compile(r"(?<=[.?!।])[\"”’»)]*\s+")
_SEP = re.compile(r"\s[›•|·»►▸/→]\s")

KINDS = ("link", "tag", "chain", "labelled", "list", "stuffed", "doorway", "sentence", "apparatus", "plain")
NAMES = (*KINDS, "length", "lines", "distinct", "phrase", "commas", "urls", "hashes", "ends", "caps", "digits", "same_lines", "offer", "joints", "glossed")


# Words of offers.
OFFER = frozenset("best buy cheap cheapest deal deals discount free lowest near now online offer order price prices sale shipping shop store top you".split())


def _stuffed(words: list[str], counts: Counter, total: int) -> bool:
    """A sentence that repeats the page's own phrases or is made of words of offers."""
    n = len(words)
    if n >= 3 and (k := sum(w in OFFER for w in words)) >= 2 and k >= 0.34 * n:
        return True
    if n < 8:
        return False
    long = [w for w in words if len(w) > 3]
    few = n >= 10 and len(set(words)) < 0.62 * n
    if not (few or (len(long) >= 6 and len(long) - len(set(long)) >= 0.3 * len(long))):
        return False
    return max((counts[w] for w, k in Counter(long).items() if k > 1), default=0) >= max(6, 0.05 * total)


def features(text: str) -> list[float]:
    """Shares of the characters in lines of each kind, and measures of repetition.

    A blank text has only zeros. The cost grows with the length of the text alone."""
    out = dict.fromkeys(NAMES, 0.0)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    if not lines:
        return list(out.values())
    low = text.lower().split()
    words = [w.strip(".,;:!?\"“”’'()[]#*") for w in low]
    counts = Counter(words)
    total = len(words)
    short = [x for x in lines if len(x) < 100]
    # The phrase that most short lines share; the lines of a song repeat, those of a doorway vary.
    seen: Counter = Counter()
    for x in short:
        w = [v.strip(".,;:!?\"“”()[]") for v in x.lower().split()]
        if 3 <= len(w) <= 14:
            seen.update(set(zip(w, w[1:])))
    phrase, times = max(seen.items(), key=lambda kv: (kv[1], kv[0])) if seen else ((), 0)
    doorway = times >= 4 and times > 0.5 * len(short)
    size = dict.fromkeys(KINDS, 0)
    for x in lines:
        n = len(x)
        end = _END.search(x) is not None
        if "http" in x or "www." in x or "<a " in x:
            links = max(1, x.count("http") + x.count("www."))
            rest = _URL.sub(" ", x).split()
            if _REF.match(x):
                size["apparatus"] += n
            elif len(rest) <= 7 * links + 1 and not (end and len(rest) > 5 * links and links < 3):
                size["link"] += n
            else:
                size["sentence"] += n
            continue
        if "#" in x:
            w = x.split()
            k = sum(len(v) for v in w if v[0] == "#")
            if k > 0.5 * n:
                size["tag"] += n
                continue
        if ("›" in x or "•" in x or "|" in x or "·" in x or "→" in x) and len(_SEP.findall(x)) >= 2 and not (end and x.count("•") + x.count("›") == 0):
            size["chain"] += n
            continue
        if not end:
            w = [v.strip(".,;:!?\"“”()[]") for v in x.lower().split()]
            if _ENTRY.search(x) and not x.rstrip().endswith(")"):
                size["apparatus"] += n
            elif _LABEL.match(x) and x.count(",") >= 1:
                size["labelled"] += n
            elif x.count(",") >= 3:
                parts = [v.strip() for v in x.split(",")]
                size["list" if sum(len(v.split()) <= 5 for v in parts) > 0.7 * len(parts) else "plain"] += n
            elif doorway and len(w) >= 3 and not _GLOSS.match(x) and phrase in zip(w, w[1:]) and len(set(w)) > 0.75 * len(w):
                size["doorway"] += n
            elif _stuffed(w, counts, total) and len(w) > 8:
                size["stuffed"] += n
            elif _GLOSS.match(x):
                size["apparatus"] += n
            else:
                size["plain"] += n
            continue
        if doorway and n < 100 and not _GLOSS.match(x):
            w = [v.strip(".,;:!?\"“”()[]") for v in x.lower().split()]
            if phrase in zip(w, w[1:]) and len(w) <= 12:
                size["doorway"] += n
                continue
        for s in _CUT.split(x) if n > 200 else (x,):
            w = [v.strip(".,;:!?\"“”()[]") for v in s.lower().split()]
            if s.count(",") >= 4 and s.count(",") > 0.2 * len(w) and len({v.strip(" .").lower() for v in s.split(",")}) < 0.75 * (s.count(",") + 1):
                size["list"] += len(s)
            else:
                size["stuffed" if _stuffed(w, counts, total) else "sentence"] += len(s)
    all_ = max(1, sum(size.values()))
    for k in KINDS:
        out[k] = size[k] / all_
    big = Counter(zip(words, words[1:]))
    top = big.most_common(1)[0][1] if big else 0
    out["length"] = float(np.log1p(len(text)))
    out["lines"] = float(np.log1p(len(lines)))
    out["distinct"] = len(counts) / total
    out["phrase"] = top / max(1, total - 1)
    out["commas"] = text.count(",") / total
    out["urls"] = (text.count("http") + text.count("www.")) / total
    out["hashes"] = text.count("#") / total
    out["ends"] = sum(text.count(c) for c in ".?!।") / total
    out["caps"] = sum(1 for w in text.split() if w[0].isupper()) / total
    out["digits"] = sum(1 for w in words if w[:1].isdigit()) / total
    out["same_lines"] = 1 - len(set(lines)) / len(lines)
    out["offer"] = sum(counts[w] for w in OFFER) / total
    out["joints"] = sum(text.count(c) for c in "›•·|→▸") / total
    out["glossed"] = sum(1 for x in lines if _GLOSS.match(x)) / len(lines)
    return list(out.values())


#: Labelling rules: each looks at its own measure and is silent on most pages.
SPAM_VOTES = {
    "links": lambda f: f["urls"] >= 0.12,
    "hashtags": lambda f: f["hashes"] >= 0.3,
    "enumeration": lambda f: f["commas"] >= 0.3 and f["ends"] < 0.03,
    "offers": lambda f: f["offer"] >= 0.12,
    "joints": lambda f: f["joints"] >= 0.08,
    "repetition": lambda f: f["phrase"] >= 0.05 and f["distinct"] < 0.3 and f["same_lines"] < 0.2 and f["ends"] < 0.02,
}
OTHER_VOTES = {
    "sentences": lambda f: 0.02 <= f["ends"] <= 0.25 and f["commas"] < 0.2 and f["distinct"] >= 0.05 and f["offer"] < 0.05,
    "numbered": lambda f: f["digits"] >= 0.12 and f["urls"] < 0.1,
    "refrain": lambda f: f["same_lines"] >= 0.15 and f["commas"] < 0.15,
    "glossed": lambda f: f["glossed"] >= 0.6,
    "blank": lambda f: f["lines"] == 0,
}


def vote(f: list[float]) -> int | None:
    """1 or 0 where rules speak for one side alone."""
    named = dict(zip(NAMES, f))
    yes, no = any(v(named) for v in SPAM_VOTES.values()), any(v(named) for v in OTHER_VOTES.values())
    return int(yes) if yes != no else None


def composite(spam: str, other: str, share: float, first: bool) -> tuple[str, float]:
    """Lines of a spam page and of another up to about the share of spam, and what the share is."""
    size = min(len(spam) / share, len(other) / (1 - share), LONGEST_PAIR)

    def lines(text: str, room: float) -> list[str]:
        out: list[str] = []
        for x in text.split("\n"):
            if room <= 0:
                break
            if x and not x.isspace():
                out.append(x[: int(room) + 1] if len(x) > 2 * room else x)
                room -= len(out[-1])
        return out

    a, b = lines(spam, size * share), lines(other, size * (1 - share))
    n, m = sum(map(len, a)), sum(map(len, b))
    return "\n".join(a + b if first else b + a), n / max(1, n + m)


def page_features(docs: DataFrame) -> DataFrame:
    """doc_id, source, f array<float>, weak int of all texts that aren't NULL; weak is 1 for spam, 0
    for other text, NULL where the labelling rules are silent or contradict each other."""

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            f = [features(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "f": f, "weak": pd.array([vote(x) for x in f], dtype="Int32")})

    return docs.where("text is not null").select("doc_id", "source", "text").mapInPandas(run, "doc_id long, source string, f array<float>, weak int")


def composites(pages: DataFrame, docs: DataFrame, most: int = PAIRS) -> DataFrame:
    """f, y of composites: features and whether more than half is spam. At most ``most`` pairs of
    labelled pages, chosen by a hash of the id."""

    def some(label: int) -> DataFrame:
        got = pages.where(F.col("weak") == label).select("doc_id", F.xxhash64("doc_id", F.lit(1)).alias("h")).orderBy("h", "doc_id").limit(most)
        # At most ``most`` rows in this window and in the broadcast.
        ranked = got.withColumn("k", F.row_number().over(W.orderBy("h", "doc_id")))
        return docs.where("text is not null").select(F.col("doc_id").alias("d"), "text").join(F.broadcast(ranked.select("doc_id", "k")), F.col("d") == F.col("doc_id")).select("k", "text")

    def run(batches):
        for pdf in batches:
            rows = []
            for k, a, b in zip(pdf["k"], pdf["a"], pdf["b"]):
                # Shares of spam from 0.1 to 0.9, either part first.
                text, share = composite(a, b, 0.1 + 0.8 * ((k * 0.618034) % 1), k % 2 == 0)
                if abs(share - 0.5) > 0.02:
                    rows.append((features(text), float(share > 0.5)))
            if rows:
                yield pd.DataFrame(rows, columns=["f", "y"])

    pairs = some(1).withColumnRenamed("text", "a").join(some(0).withColumnRenamed("text", "b"), "k")
    return pairs.mapInPandas(run, "f array<float>, y double")


def train(pages: DataFrame, docs: DataFrame, sample: int = SAMPLE, most: int = PAIRS) -> Bagged | None:
    """Trees from at most ``sample`` pages of each weak label, chosen by a hash of the id, and
    composites; NULL without pages of both labels."""
    x, y = [], []
    for label in (0, 1):
        got = pages.where(F.col("weak") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("f").toPandas()
        x += list(got["f"])
        y += [float(label)] * len(got)
    if len(set(y)) < 2:
        return None
    both = composites(pages, docs, most).toPandas()
    return Bagged(np.stack(x + list(both["f"])).astype(float), np.array(y + list(both["y"])))


def judge(pages: DataFrame, docs: DataFrame, *, sample: int = SAMPLE, smooth: float = SMOOTH, prior: float = PRIOR) -> DataFrame:
    """pages: of page_features(docs). doc_id, source, page (the trees' probability), host_rate, score
    (smoothed probability).

    A NULL source is a host. Blank pages score near 0. With weak labels of only one class there is
    nothing to learn, and a page's probability is its label, a half where it has none.
    """
    model = train(pages, docs, sample)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["f"].to_numpy()).astype(float)
                p = model.predict(x) if model is not None else pdf["weak"].fillna(0.5).to_numpy(float)
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "page": p})

    scored = pages.mapInPandas(run, "doc_id long, source string, page double").withColumn("host", F.coalesce("source", F.lit("")))
    # Combined before the shuffle; one row per host.
    hosts = scored.groupBy("host").agg(F.sum("page").alias("s"), F.count("*").alias("n"))
    whole = hosts.agg((F.sum("s") / F.sum("n")).alias("r")).first()["r"]
    whole = min(max(float(whole or 0.0), 1e-3), 1 - 1e-3)
    hosts = hosts.select("host", ((F.col("s") + prior * whole) / (F.col("n") + prior)).alias("host_rate"))
    clip = F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.col("page")))
    rate = F.greatest(F.lit(0.005), F.least(F.lit(0.995), F.col("host_rate")))
    odds = F.log(clip / (1 - clip)) + smooth * (F.log(rate / (1 - rate)) - float(np.log(whole / (1 - whole))))
    return scored.join(hosts, "host").select("doc_id", "source", "page", "host_rate", (1 / (1 + F.exp(-odds))).alias("score"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    n = max(docs.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    return judge(materialise(page_features(docs.repartition(n) if n > docs.rdd.getNumPartitions() else docs)), docs)


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).where("score > 0.5").select("doc_id")


QUERIES = {"p10_scores": p10_scores, "p10_found": p10_found}
ORACLE: dict[str, str] = {}

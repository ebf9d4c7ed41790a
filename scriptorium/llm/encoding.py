"""Text decoded with the wrong encoding: finding it and giving the original back.

Every run of non-ASCII characters may have come through one of several latent chains (written in
one encoding, read in another, once or twice) or through none. What each chain would have been
before is scored by a character model of right text. Expectation-maximization estimates, for every
source and field, how often each chain was taken, and, over all sources, the character model, so
that weak evidence (a single sign, a damaged sequence) is judged by what is known of its source.
Each record is then repaired run by run by the most probable chain.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from ..tables import KEYS, latest, load, recency

LOST = "�"
ROUNDS = 3  # outer rounds of EM (character model); each has INNER rounds for every source
INNER = 12
FLOOR = 1e-6  # probability of a character never seen in right text
NEW = 1e-9  # the same where it would come from undoing a chain
LOST_P = 1e-3  # probability of a place that can't be restored
PULL = 2.0  # weight of the prior of chains, in runs
STEP = 4  # likelihoods are told apart by quarters of a nat
SALTS = 8
_RUN = re.compile(r"[^\x00-\x7f]+")

#: Readers: encodings in which UTF-8 was read. Places that an encoding leaves empty are read as
#: the control character of the same number, as common decoders do.
READERS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251")


@functools.cache
def _encoder(reader: str) -> dict[str, int]:
    out = {}
    for b in range(128, 256):
        out.setdefault(bytes([b]).decode(reader, "replace"), b)
        if reader != "latin-1":
            out.setdefault(chr(b), b) if bytes([b]).decode(reader, "replace") == LOST else None
    out.pop(LOST, None)
    return out


def _unread(run: str, reader: str, damaged: bool) -> str | None:
    """What the run was before UTF-8 was read as ``reader``; None: it can't have been.

    ``damaged``: bytes of the sequences may be missing; such places become the sign of a loss."""
    table = _encoder(reader)
    try:
        raw = bytes(table[c] for c in run)
    except KeyError:
        return None
    try:
        got = raw.decode("utf-8")
        return None if damaged or any(unicodedata.category(c) in ("Cn", "Co") for c in got) else got
    except UnicodeDecodeError:
        if not damaged or not any(b >= 0xC3 for b in raw):
            return None
    got = re.sub(LOST + "+", LOST, raw.decode("utf-8", "replace"))
    if any(unicodedata.category(c) in ("Cn", "Co") for c in got):
        return None
    # Something must speak for UTF-8: a whole sequence, two bytes of one of Latin Extended
    # Additional or of general punctuation, or the first byte of most Latin letters where its sign
    # is no letter of right text.
    begun = len(raw) == 2 and (raw[0] == 0xE1 and 0xB8 <= raw[1] <= 0xBB or raw[0] == 0xE2 and 0x80 <= raw[1] <= 0x86)
    lone = len(raw) == 1 and raw[0] == 0xC3 and reader != "mac_roman"
    return got if begun or lone or got.strip(LOST) else None


def _swap(run: str, written: str, reader: str) -> str | None:
    """One-byte text of one encoding read in another."""
    try:
        got = run.encode(reader).decode(written)
    except UnicodeError:
        return None
    return got if got != run else None


def _chains() -> list[tuple[str, object]]:
    once = [(f"utf-8>{r}", lambda s, r=r: _unread(s, r, False)) for r in READERS]
    twice = [(f"utf-8>{r}>{r}", lambda s, r=r: (lambda a: a and _RUN.fullmatch(a) and _unread(a, r, False))(_unread(s, r, False)) or None) for r in READERS]
    hurt = [(f"utf-8>{r} damaged", lambda s, r=r: _unread(s, r, True)) for r in ("cp1252", "mac_roman", "cp437", "cp1251")]
    hurt.append(("utf-8>latin-1 damaged", lambda s: _unread(s, "latin-1", True) if any("\x80" <= c <= "\x9f" for c in s) else None))
    bytes_ = [("cp1252>cp1251", lambda s: _swap(s, "cp1252", "cp1251")), ("cp1252>latin-1", lambda s: _swap(s, "cp1252", "latin-1") if any("\x80" <= c <= "\x9f" for c in s) else None)]
    return once + twice + hurt + bytes_ + [("lost", lambda s: s if LOST in s else None)]


CHAINS = _chains()
NAMES = [n for n, _ in CHAINS]


@functools.lru_cache(200_000)
def readings(run: str) -> tuple[tuple[int, str], ...]:
    """Chains the run may have come through, with what it was before."""
    out, seen = [], set()
    for i, (_, f) in enumerate(CHAINS):
        got = f(run)
        if got is not None and got not in seen:
            seen.add(got)
            out.append((i, got))
    return tuple(out)


_CAPITALS = re.compile(r"(?:(?<=[A-Z])[^\x00-\x7f](?![a-z])|(?<![a-z])[^\x00-\x7f](?=[A-Z]))")


def runs_of(text: str) -> Counter:
    """The non-ASCII runs of a text. A capital on its own in a word of capitals is right text and
    counted with a letter before it, which no chain explains."""
    runs = Counter(_RUN.findall(text))
    for r in [r for r in runs if len(r) == 1 and r.isupper() and readings(r)]:
        k = sum(m[0] == r and not _RUN.match(text[m.end() : m.end() + 1]) and not _RUN.match(text[max(0, m.start() - 1) : m.start()]) for m in _CAPITALS.finditer(text))
        if k:
            runs["A" + r] = k
            runs[r] -= k
    return +runs


def scan(rows: DataFrame) -> DataFrame:
    """rows: src_table, row_id, ts bigint, source bigint, field, text. One row each with ``runs``
    and ``counts``: its runs that some chain explains. Rows with NULL row_id and field ``model``
    hold, for each batch, the characters of all other runs: right text to begin with."""

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            right: Counter = Counter()
            runs, counts = [], []
            for t in pdf["text"]:
                mine: Counter = Counter()
                if t is not None and not t.isascii():
                    for r, n in runs_of(t).items():
                        if readings(r):
                            mine[r] = n
                        else:
                            for c in r:
                                if c >= "\x80":
                                    right[c] += n
                runs.append(list(mine))
                counts.append(list(mine.values()))
            yield pdf.drop(columns="text").assign(runs=runs, counts=counts)
            if right:
                yield pd.DataFrame({"src_table": [None], "row_id": pd.array([None], dtype="Int64"), "ts": [0], "source": pd.array([None], dtype="Int64"), "field": ["model"], "runs": [list(right)], "counts": [list(right.values())]})

    return rows.select("src_table", "row_id", "ts", "source", "field", "text").mapInPandas(run, "src_table string, row_id long, ts long, source long, field string, runs array<string>, counts array<long>")


def _score(model: dict[str, float], s: str, floor: float = FLOOR) -> float:
    return sum(np.log(LOST_P if c == LOST else 1.0 if c < "\x80" else max(floor, model.get(c, 0.0))) for c in s)


CERTAIN = 15.0  # so many nats ahead of all chains a run is right text whatever its source


class _Evidence:
    """Likelihoods of runs under right text (column 0) and the chains, each run scored once."""

    def __init__(self, model: dict[str, float]) -> None:
        self.model, self.seen = model, {}

    def of(self, run: str):
        got = self.seen.get(run)
        if got is None:
            before = dict(readings(run))
            like = np.full(len(CHAINS) + 1, -np.inf)
            like[0] = _score(self.model, run) if LOST not in run else -60.0
            for c, s in before.items():
                like[c + 1] = _score(self.model, s, NEW)
            got = self.seen[run] = (like, before, like[0] - like[1:].max(initial=-np.inf) > CERTAIN)
        return got

    def signature(self, run: str) -> str:
        """How far each explanation is behind the best, in steps; "" where right text is certain."""
        like, _, certain = self.of(run)
        if certain:
            return ""
        d = np.rint((like - like.max()) * STEP)
        return " ".join(f"{k}:{int(d[k])}" for k in np.flatnonzero(d > -80 * STEP))


_PRIOR = np.full(len(CHAINS) + 1, 0.1 / len(CHAINS))
_PRIOR[0] = 0.9


def _signed(model: dict[str, float]):
    """source, field, run, n to source, field, sig, n, added up within a batch."""
    evidence = _Evidence(model)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                sig = [evidence.signature(r) for r in pdf["run"]]
                yield pdf.assign(sig=sig).groupby(["source", "field", "sig"], dropna=False, as_index=False, sort=False)["n"].sum().astype({"source": "Int64"})

    return run


def _shares(pdf: pd.DataFrame) -> pd.DataFrame:
    """EM for the shares of the chains of every source and field in the frame, all at once, each
    with a prior of PULL runs. Rows: source, field, sig, n."""
    out = ["source", "field", "pi"]
    if pdf.empty:
        return pd.DataFrame({c: [] for c in out})
    group, keys = pdf.groupby(["source", "field"], dropna=False, sort=False).ngroup().to_numpy(), pdf[["source", "field"]].drop_duplicates()
    groups = len(keys)
    n = pdf["n"].to_numpy(float)
    at = np.flatnonzero(pdf["sig"].to_numpy() != "")
    like = np.full((len(at), len(CHAINS) + 1), -np.inf)
    for row, i in enumerate(at):
        for x in pdf["sig"].iat[i].split(" "):
            k, v = x.split(":")
            like[row, int(k)] = int(v) / STEP
    m, g = n[at], group[at]
    sure = np.bincount(group, n, groups) - np.bincount(g, m, groups)
    pi = np.tile(_PRIOR, (groups, 1))
    total = np.bincount(group, n, groups)[:, None] + PULL
    for _ in range(INNER):
        w = np.exp(like) * pi[g]
        w /= w.sum(axis=1, keepdims=True)
        new = np.stack([np.bincount(g, m * w[:, k], groups) for k in range(len(CHAINS) + 1)], 1) + PULL * _PRIOR
        new[:, 0] += sure
        new = np.maximum(new / total, 1e-12)
        done = np.abs(new - pi).max() < 1e-4
        pi = new
        if done:
            break
    return keys.assign(pi=list(pi)).astype({"source": "Int64"})[out]


def _weights(evidence: _Evidence, pdf: pd.DataFrame):
    """Places of the runs that aren't certain, their posteriors and readings."""
    got = [evidence.of(r) for r in pdf["run"]]
    at = np.flatnonzero([not g[2] for g in got])
    if not len(at):
        return at, np.zeros((0, len(CHAINS) + 1)), []
    like = np.stack([got[i][0] for i in at])
    w = np.exp(like - like.max(axis=1, keepdims=True)) * np.stack(pdf["pi"].to_numpy()[at])
    return at, w / w.sum(axis=1, keepdims=True), [got[i][1] for i in at]


def _judge(model: dict[str, float]):
    evidence = _Evidence(model)
    kinds = {"source": "Int64", "field": object, "run": object, "chain": object, "before": object, "p": "float64"}

    def run(batches):
        for pdf in batches:
            source, out = pdf["source"].tolist(), []
            for i, w, before in zip(*_weights(evidence, pdf)):
                c = int(w[1:].argmax())
                if w[0] < 0.5 and c in before:
                    out.append((None if pd.isna(source[i]) else int(source[i]), pdf["field"].iat[i], pdf["run"].iat[i], NAMES[c], before[c], 1 - w[0]))
            if out:
                yield pd.DataFrame(out, columns=list(kinds)).astype(kinds)

    return run


def _expect(model: dict[str, float]):
    evidence = _Evidence(model)

    def run(batches):
        for pdf in batches:
            n, runs = pdf["n"].to_numpy(float), list(pdf["run"])
            mass: Counter = Counter()
            for i, w, before in zip(*_weights(evidence, pdf)):
                for c, s in [(-1, runs[i]), *before.items()]:
                    if w[c + 1] > 0.9:
                        for ch in s:
                            if ch >= "\x80" and ch != LOST:
                                mass[ch] += n[i] * w[c + 1]
            if mass:
                yield pd.DataFrame({"c": pd.Series(list(mass), dtype=object), "m": pd.Series(list(mass.values()), dtype=float)})

    return run


def decide(scanned: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """scanned: rows of ``scan`` that count. Returns source, field, run, chain, before, p: for all
    runs of a source and field that are more probably wrong than right.

    Likelihoods are worked out run by run, wherever a source's rows lie, and added up for each
    source and field by their signature before they meet, so a source of any size brings the EM no
    more rows than there are signatures (STEP tells likelihoods apart). Its shares are then carried
    back to its runs, salted. The character model, one number for each character, is kept on the
    driver.
    """
    flat = F.explode(F.arrays_zip("runs", "counts")).alias("x")
    pairs = scanned.where("field <> 'model'").select("source", "field", flat).groupBy("source", "field", F.col("x.runs").alias("run")).agg(F.sum("x.counts").alias("n"))
    pairs = materialise(pairs.withColumn("salt", F.pmod(F.xxhash64("run"), F.lit(SALTS)).cast("int")))
    # One row for each character there is.
    base = {r["c"]: float(r["n"]) for r in scanned.where("field = 'model'").select(flat).groupBy(F.col("x.runs").alias("c")).agg(F.sum("x.counts").alias("n")).toLocalIterator()}
    counts = base
    kind = "source long, field string, run string, chain string, before string, p double"
    for k in range(rounds):
        total = sum(counts.values()) or 1.0
        model = {c: v / total for c, v in counts.items()}
        signed = pairs.select("source", "field", "run", "n").mapInPandas(_signed(model), "source long, field string, sig string, n long").groupBy("source", "field", "sig").agg(F.sum("n").alias("n"))
        # Sources are judged many at a time; all rows of a bucket are a few thousand signatures each.
        shares = signed.groupBy(F.pmod(F.xxhash64("source", "field"), F.lit(max(16, pairs.rdd.getNumPartitions())))).applyInPandas(_shares, "source long, field string, pi array<double>")
        spread = shares.select(F.col("source").alias("s"), F.col("field").alias("f"), "pi", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("t"))
        known = pairs.join(spread, F.expr("source <=> s and field = f and salt = t")).select("source", "field", "run", "n", "pi")
        if k == rounds - 1:
            return known.mapInPandas(_judge(model), kind)
        got = known.mapInPandas(_expect(model), "c string, m double").groupBy("c").agg(F.sum("m").alias("m"))
        counts = dict(base)
        for r in got.toLocalIterator():
            counts[r["c"]] = counts.get(r["c"], 0.0) + r["m"]
    raise ValueError("rounds must be 1 at least")


def wrong_runs(scanned: DataFrame) -> DataFrame:
    """src_table, row_id, field, run, chain, before, p of all records with a wrong run. A record
    whose text is NULL, empty or ASCII has none; repeated rows give repeated results."""
    found = decide(scanned).select(F.col("source").alias("s"), F.col("field").alias("f"), F.col("run").alias("r"), "chain", "before", "p")
    # A run may stand in a large part of a source's records: its rows are spread.
    found = materialise(found).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = scanned.where("field <> 'model'").select("src_table", "row_id", "source", "field", F.explode("runs").alias("run"), F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int").alias("salt"))
    return each.join(found, F.expr("source <=> s and field = f and run = r and salt = t")).select("src_table", "row_id", "field", "run", "chain", "before", "p")


def repair(texts: DataFrame, wrong: DataFrame) -> DataFrame:
    """texts: src_table, row_id, field, text. Adds ``repaired`` for the records of ``wrong``; what
    can't be restored is shown by the sign of a loss."""
    fix = wrong.groupBy("src_table", "row_id", "field").agg(F.map_from_entries(F.collect_set(F.struct("run", "before"))).alias("fix"))

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            done = []
            for t, f in zip(pdf["text"], pdf["fix"]):
                m = dict(f)
                done.append(None if t is None else _RUN.sub(lambda x: m.get(x[0], x[0]), t))
            yield pdf.drop(columns="fix").assign(repaired=done)

    return texts.join(fix, ["src_table", "row_id", "field"]).select("src_table", "row_id", "field", "text", "fix").mapInPandas(run, "src_table string, row_id long, field string, text string, repaired string")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of all records, one row for each field."""
    content = load(spark, sf_dir, "content").select(F.lit("content").alias("src_table"), F.col("content_id").alias("row_id"), recency("content").alias("ts"), F.col("book_id").cast("long").alias("source"), F.lit("page").alias("field"), F.col("page_content").alias("text"))
    g = load(spark, sf_dir, "dangerous_glyph_words")
    base = [F.lit("dangerous_glyph_words").alias("src_table"), F.col("id").alias("row_id"), recency("dangerous_glyph_words").alias("ts"), F.col("book_id").cast("long").alias("source")]
    glyph = g.select(*base, F.lit("glyph").alias("field"), F.col("glyph").alias("text"))
    words = g.select(*base, F.lit("words").alias("field"), F.array_join("sample_words", "\n").alias("text"))
    return content.unionByName(glyph).unionByName(words)


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of current rows; texts are read once and never shuffled."""
    s = scan(_texts(spark, sf_dir))
    cols = ["src_table", "row_id", "field", "source", "runs", "counts"]
    now = latest(s.where("field <> 'model'"), ["src_table", "row_id", "field"], F.col("ts"), cols)
    return materialise(now.unionByName(s.where("field = 'model'").select(*cols)))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrong_runs(_scanned(spark, sf_dir)).select("src_table", "row_id").distinct()


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every affected field with its original text."""
    now = latest(_texts(spark, sf_dir), ["src_table", "row_id", "field"], F.col("ts"), ["src_table", "row_id", "field", "text"])
    return repair(now, wrong_runs(_scanned(spark, sf_dir)))


QUERIES = {"p1_found": p1_found, "p1_repaired": p1_repaired}
ORACLE: dict[str, str] = {}

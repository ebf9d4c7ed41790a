"""Noise of scanned pages: cut words, misread letters, running titles and page numbers.

One pass over the pages counts the words and takes from every page what may be noise: words cut at
line ends, the lines at its top and bottom. Misread words are found among the different words of
the corpus: candidates for each come from an inverted join of character trigrams, and boosted trees
rank them; boosted trees also judge pairs of lines (does the hyphen join them, is this line the
page's furniture). All are trained on bounded samples of weak labels. A second pass applies the
decisions.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from ..tables import latest, load, recency
from .trees import Boosted

SAMPLE = 4_000  # rows of each weak label used for training, at most
KNOWN = 200_000  # most frequent word forms that the second pass need not look up
RATIO = 8.0  # so many times as frequent as the misread form must the correction be
OFTEN, SELDOM = 0.03, 0.01  # rates from which an operation is a confusion, and below which it is none
SALTS = 4
FLUSH = 400_000

# Shapes that scanners confuse (as read, as printed).
CONFUSED = frozenset(
    [("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("5", "s"), ("9", "g"), ("6", "b"), ("8", "b"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("ri", "n"), ("li", "h")]
    + [("c", "e"), ("e", "c"), ("u", "a"), ("f", "t"), ("b", "h"), ("l", "i"), ("o", "e"), ("n", "u"), ("in", "m"), ("tn", "m"), ("lc", "k"), ("nn", "m"), ("h", "b"), ("t", "f"), ("i", "l"), ("h", "li"), ("d", "cl")]
)
HYPHENS = "-‐­¬"
_BROKEN = re.compile(r"(\S*[^\W\d_])([-‐­¬])[ \t]*\r?\n\s*([^\W\d_]\S*)")
_TAIL = re.compile(r"(\S*[^\W\d_])([-‐­¬])\s*$")
_STRIP = "\"'“”‘’„«»()[]{}.,;:?!—–…*"
_SOFT = "\"'“”‘’„«»()[]{}.,;:?—–…*"
_ROMAN = r"[ivxlcdm]+"
_NUM = rf"(?:\d{{1,4}}|{_ROMAN})"
_ALONE = re.compile(rf"^[\s\-–—~\[\](){{}}.•*·=<>]*(?:page|pg\.?|p\.)?[\s\-–—~\[\](){{}}.•*·=<>]*({_NUM}|\d(?: \d)+|[ivxlcdm](?: [ivxlcdm])+)[\s\-–—~\[\](){{}}.•*·=<>]*$", re.I)
_FRONT = re.compile(rf"^\s*[\[(]?(?:page )?({_NUM})[\])]?(?:\s{{2,}}|\s*[|·•–—]\s+|\s+)(?=\S)", re.I)
_BACK = re.compile(rf"(?<=\S)(?:\s{{2,}}|\s+[|·•–—]\s*|\s+)[\[(]?(?:page )?({_NUM})[\])]?\s*$", re.I)
_WIDE_FRONT = re.compile(rf"^\s*[\[(]?{_NUM}[\])]?(?:\s{{2,}}|\s*[|·•–—]\s+)\S", re.I)
_WIDE_BACK = re.compile(rf"\S(?:\s{{2,}}|\s+[|·•–—]\s*)[\[(]?(?:page )?{_NUM}[\])]?\s*$", re.I)
_OPENING = re.compile(r"^\s*(?:chapter|canto|part|book|section|lesson|kapitel|cap[ií]tulo|chapitre)\b", re.I)


def bare(token: str) -> str:
    """A word without the signs around it, in lower case."""
    t = token.strip(_SOFT)
    if t[-1:] == "!" and t[:-1].isalpha():
        t = t[:-1]
    return t.lower()


# Groups of shapes that a scanner may take for each other, longest first.
_FOLD = [("rn", "m"), ("ri", "n"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("li", "h"), ("0", "o"), ("1", "l"), ("!", "l"), ("|", "l"), ("i", "l"), ("5", "s"), ("9", "g"), ("c", "e"), ("u", "a"), ("f", "t"), ("b", "h")]


@functools.lru_cache(50_000)
def skeleton(line: str) -> str:
    """Form of a line that stays the same under misread letters, letter spacing and case."""
    if "||" in line:  # a verse number
        return ""
    s = re.sub(r"[\s\W_]+", "", line.lower().replace("!", "i").replace("|", "l"))
    for a, b in _FOLD:
        s = s.replace(a, b)
    return s


def _edge(lines: list[str]) -> list[tuple[int, str]]:
    """Lines at the top (0, 1) and bottom (2, 3) of a page."""
    top = [(i, x) for i, x in enumerate(lines[:2])]
    bottom = [(2 + i, x) for i, x in enumerate(lines[: max(1, len(lines) - 3) : -1]) if len(lines) - 1 - i >= len(top)]
    return top + bottom


@functools.lru_cache(50_000)
def furniture(line: str) -> tuple[str, bool, bool]:
    """The line without its page number, whether it is a page number alone, whether it has one."""
    if "||" in line or not (line[-1:].isalnum() or line[:1].isalnum() or len(line) < 24):
        return line, False, False
    if _ALONE.match(line):
        return "", True, True
    for wide, cut in ((_WIDE_FRONT, _FRONT), (_WIDE_BACK, _BACK)):
        if wide.search(line):
            return cut.sub("", line, count=1), False, True
    return line, False, False


_ENDS = frozenset(HYPHENS + ".,;:?!”\"|’)»")


def cuts_of(lines: list[str]) -> list[tuple[str, str, str]]:
    """Word, hyphen sign and rest of the words that go on in the next line."""
    out = []
    for x, y in zip(lines, lines[1:]):
        if x[-1] in HYPHENS and y[0].isalpha():
            left = x.rsplit(None, 1)[-1]
            if len(left) > 1 and left[-2].isalpha():
                out.append((left[:-1], left[-1], y.split(None, 1)[0]))
    return out


_CUT = re.compile(rf"[{HYPHENS}]\s*\n")


def forms_of(text: str) -> set[str]:
    """The word forms of a page, cut words whole; their parts only where they stand alone as well."""
    tokens = text.split()
    if not _CUT.search(text):
        return {x for x in tokens if x[-1] not in HYPHENS}
    cuts = cuts_of([y for x in text.split("\n") if (y := x.strip())])
    n = Counter(tokens)
    n.subtract(r for _, _, r in cuts)
    return {x for x, k in n.items() if k > 0 and x[-1] not in HYPHENS} | {l + r for l, _, r in cuts}


def scan_pages(rows: DataFrame) -> DataFrame:
    """rows: id, ts, book, page, text. Flat rows of several kinds, in columns a, b, c and others:

    ``edge`` (a line at the top or bottom of a page), ``inner`` (one from within), ``cut`` (a: word, b: hyphen, c: rest),
    ``tail`` (a word cut at the end of the page), ``head`` (c: first word of a line at the top),
    ``title`` (c: form of the heading of an opening page) and ``word`` (a: word form, n: count)."""

    def run(batches):
        words: Counter = Counter()
        for pdf in batches:
            out: list[tuple] = []
            for i, ts, book, page, text in zip(pdf["id"], pdf["ts"], pdf["book"], pdf["page"], pdf["text"]):
                if text is None or text.isspace() or not text:
                    continue
                key = (i, ts, book, page)
                lines = [y for x in text.split("\n") if (y := x.strip())]
                # The body's last line, without furniture below it.
                low = len(lines)
                while low > 1 and len(lines) - low < 2 and (x := lines[low - 1])[-1] not in _ENDS and len(x.split()) <= 10 and (x[0].isupper() or furniture(x)[1]):
                    low -= 1
                if low == len(lines) and low > 1 and furniture(lines[-1])[1]:
                    low -= 1
                words.update(text.split())
                for left, sign, right in cuts_of(lines[:low]):
                    words[left + sign] -= 1
                    words[right] -= 1
                    words[left + right] += 1
                    out.append((*key, "cut", left, sign, right, *_NONE))
                if lines[low - 1][-1] in HYPHENS and (m := _TAIL.search(lines[low - 1])):
                    out.append((*key, "tail", m[1], m[2], None, *_NONE))
                out += [(*key, "head", None, None, x.split(None, 1)[0], *_NONE) for x in lines[:4]]
                opening = bool(_OPENING.match(lines[0])) or (len(lines) > 1 and bool(_OPENING.match(lines[1])) and furniture(lines[0])[1])
                most = max(map(len, lines))
                # A line from within the page shows what lines look like that are no furniture.
                inner = [(i % 4, lines[2 + i * 31 % (len(lines) - 4)])] if len(lines) > 6 else []
                for kind, (pos, x) in [*(("edge", e) for e in _edge(lines)), *(("inner", e) for e in inner)]:
                    core, alone, has = furniture(x)
                    ends, lower = x[-1] in _STOPS, x[0].islower()
                    body = (ends or lower) and not has
                    if kind == "inner" and (body or alone):
                        continue
                    w = [v for v in core.split() if v[0].isalpha()]
                    titled, n, up = sum(v[0].isupper() for v in w) / max(1, len(w)), len(w), core.isupper()
                    out.append((*key, kind, None if body else x, None, "" if body or kind == "inner" else skeleton(core), pos, alone, has, titled, up, ends, len(x) / most, lower, n, opening))
                if opening:
                    rest = [x for x in lines[:5] if not _OPENING.match(x) and not furniture(x)[1]]
                    if rest:
                        out.append((*key, "title", None, None, skeleton(rest[0]), *_NONE))
            if out:
                yield _frame(out)
            if len(words) > FLUSH:
                yield _frame([(None, 0, None, None, "word", w, None, None, *_NONE[:-2], n, False) for w, n in words.items() if n > 0 or n < 0])
                words = Counter()
        if words:
            yield _frame([(None, 0, None, None, "word", w, None, None, *_NONE[:-2], n, False) for w, n in words.items() if n > 0 or n < 0])

    return rows.mapInPandas(run, _PAGE)


_STOPS = frozenset('.,;:?!”"’»|)' + HYPHENS[:1])
_NONE = (0, False, False, 0.0, False, False, 0.0, False, 0, False)
_EDGE = ["pos", "alone", "has", "title", "upper", "ends", "width", "lower", "n", "opening"]
_PAGE = "id long, ts long, book long, page long, kind string, a string, b string, c string, pos int, alone boolean, has boolean, title double, upper boolean, ends boolean, width double, lower boolean, n long, opening boolean"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=["id", "ts", "book", "page", "kind", "a", "b", "c", *_EDGE])
    for c in ("id", "book", "page"):
        f[c] = f[c].astype("Int64")
    for c in ("a", "b", "c"):
        f[c] = f[c].astype(object).where(f[c].notna(), None)
    return f


def vocabulary(scanned: DataFrame) -> DataFrame:
    """raw, word, n: every word form with its bare word and its count."""
    forms = scanned.where("kind = 'word'").groupBy(F.col("a").alias("raw")).agg(F.sum("n").alias("n")).where("n > 0")

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(word=[bare(x) for x in pdf["raw"]])

    return forms.mapInPandas(run, "raw string, n long, word string").where("word <> ''")


def _grams(word: str = "word"):
    """Trigrams of a word with where they stand: those of its first half counted from the beginning,
    the others from the end. One confusion leaves those of the other half as they are."""
    padded = F.concat(F.lit("^^"), F.col(word), F.lit("$$"))
    last = F.length(padded) - 2
    place = lambda i: F.when(i * 2 <= last + 1, i).otherwise(i - last - 1)
    # Both ends are met by two letters; one alone is met in short words only.
    inner = F.when(F.length(word) <= 4, F.sequence(F.lit(1), last)).otherwise(F.sequence(F.lit(2), last - 1))
    return F.transform(inner, lambda i: F.concat(F.substr(padded, i, F.lit(3)), place(i).cast("string")))


def edit(a: str, b: str) -> tuple[str, str]:
    """What differs between two words once their common beginning and end are taken off."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return a[i : len(a) - j], b[i : len(b) - j]


def _edits(a: str, b: str) -> list[tuple[str, str]] | None:
    """One or two separate confusions that turn b into a; None: something else is different."""
    x, y = edit(a, b)
    if (x, y) in CONFUSED or (len(x) <= 2 and len(y) <= 2):
        return [(x, y)]
    for p, q in CONFUSED:
        if x.startswith(p) and y.startswith(q):
            r = edit(x[len(p) :], y[len(q) :])
            if r in CONFUSED:
                return [(p, q), r]
    return None


_RANK = ["ratio", "ln", "lv", "length", "support", "odd", "edits", "plain", "first", "last", "marks", "beyond"]
# Latin letters with marks and those without.
_MARKED = {c: unicodedata.normalize("NFD", c)[0] for lo, hi in ((0xE0, 0x250), (0x1E00, 0x1F00)) for c in map(chr, range(lo, hi)) if unicodedata.normalize("NFD", c) != c}


def operations(pairs: DataFrame, strong: DataFrame) -> DataFrame:
    """op, half, rate, seen: how often words that have the right shape of an operation also have a form
    misread by it, among the words of each half of the vocabulary.

    pairs: v, op, edits. strong: v. A shape that scanners confuse is confused in any word that has it, so
    its rate is high in both halves; two words that are alike by chance are no sample of others."""
    half = F.pmod(F.xxhash64("v"), F.lit(2)).alias("half")
    single = pairs.where("edits = 1").select("v", "op", F.substring_index("op", ">", -1).alias("shape"), half).distinct()
    parts = lambda n: F.when(F.length("v") >= n, F.transform(F.sequence(F.lit(1), F.length("v") - (n - 1)), lambda i: F.substr("v", i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    have = strong.select("v", half, F.explode(F.array_distinct(F.concat(parts(1), parts(2)))).alias("shape")).groupBy("shape", "half").agg(F.count("*").alias("have"))
    n = single.groupBy("op", "shape", "half").agg(F.count("*").alias("seen"))
    return n.join(have, ["shape", "half"]).select("op", "half", (F.col("seen") / F.col("have")).alias("rate"), "seen")


def misread(vocab: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """word, correction, p of all words judged to be misread forms of others.

    vocab: word, n (different words). Trigrams of words, with their places, are joined with those of
    words RATIO times as frequent; a pair must differ by one or two shapes. No word is left out for its
    trigrams being frequent. The trees rank the pairs; they are trained on what the other half of the
    vocabulary says about a pair's operation: pairs of operations that are frequent there are misread
    words, as are words with a digit, a bar or an exclamation mark in them; pairs of rare operations
    aren't, and neither are other spellings: words that differ in marks alone
    or have signs beyond ASCII where the correction has others."""
    v = materialise(vocab.where("length(word) >= 2"))
    # A correction is RATIO times as frequent as a word that occurs once, at least.
    strong = v.where((F.col("n") >= RATIO) & (F.length("word") >= 3) & F.col("word").rlike(r"^\p{L}[^\d!|]*$")).select(F.col("word").alias("v"), F.col("n").alias("vn"))
    weak = v.where(F.col("word").rlike(r"\p{L}")).select("word", "n", F.explode(F.array_distinct(_grams())).alias("g"), F.length("word").alias("len"))
    post = strong.select("v", "vn", F.explode(F.array_distinct(_grams("v"))).alias("g"), F.length("v").alias("vlen"))
    met = weak.join(post, "g").where((F.abs(F.col("len") - F.col("vlen")) <= 2) & (F.col("vn") >= RATIO * F.col("n"))).groupBy("word", "v").agg(F.count("*").alias("shared"), F.first("n").alias("n"), F.first("vn").alias("vn"), F.first("len").alias("len"))
    # A confusion leaves the trigrams of the other half, two leave those of both ends.
    met = met.where(F.col("shared") >= 1 + F.floor(F.col("len") / 8))

    def diffs(batches):
        for pdf in batches:
            e = [_edits(a, b) for a, b in zip(pdf["word"], pdf["v"])]
            ok = [x is not None and all(p and q for p, q in x) for x in e]
            pdf = pdf[ok]
            e = [x for x, k in zip(e, ok) if k]
            if e:
                yield pdf[["word", "v", "n", "vn"]].assign(op=["+".join(f"{p}>{q}" for p, q in x) for x in e], edits=[len(x) for x in e], listed=[all(t in CONFUSED for t in x) for x in e])

    pairs = materialise(met.mapInPandas(diffs, "word string, v string, n long, vn long, op string, edits int, listed boolean"))
    # One row for each operation.
    ops = pairs.groupBy("op").agg(F.count_distinct("v").alias("support"))
    told = operations(pairs, strong).select("op", "rate", "seen", (1 - F.col("half")).alias("half"))
    number = lambda c: F.col(c).cast("double").alias(c)
    plain = lambda c: F.translate(c, "".join(_MARKED), "".join(_MARKED.values()))
    f = pairs.withColumn("half", F.pmod(F.xxhash64("v"), F.lit(2))).join(ops, "op").join(told, ["op", "half"], "left").select(
        "word", "v", F.col("rate").alias("told"), "seen",
        F.log10(F.col("vn") / F.col("n")).alias("ratio"), F.log10("n").alias("ln"), F.log10("vn").alias("lv"), F.length("word").cast("double").alias("length"),
        F.log10("support").alias("support"), F.col("word").rlike(r"\w*[0-9!|]\w*").cast("double").alias("odd"), number("edits"), F.col("word").rlike("^[a-z]+$").cast("double").alias("plain"), "listed",
        (F.substring("word", 1, 1) == F.substring("v", 1, 1)).cast("double").alias("first"), (F.right("word", F.lit(1)) == F.right("v", F.lit(1))).cast("double").alias("last"),
        (plain(F.col("word")) == plain(F.col("v"))).cast("double").alias("marks"), F.regexp_replace("op", ">[^+]*", "").rlike(r"[^\x00-\x7f]").cast("double").alias("beyond"),
    )
    f = materialise(f)
    x, y = [], []
    seldom = (F.col("edits") == 1) & (F.col("odd") == 0) & (F.coalesce("told", F.lit(0.0)) < SELDOM)
    sure = F.when((F.col("marks") == 1) | (F.col("beyond") == 1) | seldom, 0).when(((F.col("told") >= OFTEN) & (F.col("seen") >= 3)) | ((F.col("odd") == 1) & (F.col("edits") == 1)), 1)
    for label in (0, 1):
        got = f.where(sure == label).orderBy(F.xxhash64("word", "v"), "word", "v").limit(sample).select(*_RANK).toPandas()
        x.append(got.to_numpy(float))
        y.append(np.full(len(got), float(label)))
    model = Boosted(np.concatenate(x), np.concatenate(y)) if len(x[0]) > 20 and len(x[1]) > 20 else None

    def rank(batches):
        for pdf in batches:
            if len(pdf):
                # Too few words to learn from: the shapes that are known to be confused.
                yield pdf[["word", "v", "support"]].assign(p=model.predict(pdf[_RANK].to_numpy(float)) if model is not None else pdf["listed"].astype(float))

    scored = f.mapInPandas(rank, "word string, v string, support double, p double")
    # Of corrections that are as probable the one whose operation is known from more words.
    best = W.partitionBy("word").orderBy(F.desc(F.round("p", 1)), F.desc("support"), "v")
    return scored.withColumn("k", F.row_number().over(best)).where("k = 1 and p >= 0.5").select("word", F.col("v").alias("correction"), "p")


def _counts(rows: DataFrame, words: DataFrame, forms: dict[str, Column]) -> DataFrame:
    """Adds n_<name>, the count of each form of a row (0: unknown), by one join. Rows must differ."""
    keys = rows.columns
    long = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), c.alias("w")) for k, c in forms.items()])).alias("z")).select(*keys, "z.k", "z.w")
    met = long.join(words.select("word", F.col("n").alias("_n")), F.col("w") == F.col("word"), "left")
    return met.groupBy(*keys).agg(*[F.coalesce(F.max(F.when(F.col("k") == k, F.col("_n"))), F.lit(0).cast("long")).alias(f"n_{k}") for k in forms])


def _cut_features(cuts: DataFrame, words: DataFrame) -> DataFrame:
    """Counts of the joined, hyphenated and single words of a cut; r is '' where it isn't known."""
    l, r = F.col("l"), F.col("r")
    known = lambda c: F.when(r != "", c)
    return _counts(cuts, words, {"joined": known(F.concat(l, r)), "whole": known(F.concat(l, F.lit("-"), r)), "l": l, "r": known(r)})


def hyphens(cuts: DataFrame, words: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """cuts: l, r, sign, last (different cuts; last: at the end of a page, where r is only a candidate or
    ''). Adds p: that the hyphen was inserted.

    Signs that no compound is written with were inserted; whole compounds of the vocabulary, cut at
    their own hyphen, were not. Boosted trees learn from both what the counts of the parts say, also
    where the second part isn't known, and judge the cuts at plain hyphens."""
    c = materialise(_cut_features(cuts, words))
    own = words.where(F.col("word").rlike(r"^[^\W\d_]{2,}-[^\W\d_]{2,}$") & (F.col("n") >= 2)).orderBy(F.xxhash64("word"), "word").limit(sample).select(F.split("word", "-").alias("s"), F.lit("-").alias("sign"), "n")
    no = _cut_features(own.select(F.col("s")[0].alias("l"), F.col("s")[1].alias("r"), "sign"), words)
    yes = c.where("sign <> '-' and not last").orderBy(F.xxhash64("l", "r"), "l", "r").limit(sample)

    def x_of(p: pd.DataFrame, seen: np.ndarray, blind: bool = False) -> np.ndarray:
        """seen: how many occurrences of the joined word are this cut itself; blind: r isn't known."""
        known = (p["r"] != "").to_numpy() & (not blind)
        n = np.log1p(p[["n_joined", "n_l", "n_r"]].to_numpy(float))
        # One occurrence of the compound may be this one: whether it is known otherwise.
        h = np.log1p(np.maximum(p["n_whole"].to_numpy(float) - 1, 0))
        j = np.log1p(np.maximum(p["n_joined"].to_numpy(float) - seen, 0))
        on = lambda v: np.where(known, v, -1.0)
        return np.column_stack([n[:, 1], on(n[:, 2]), on(h > 0), on(j > 0), on(np.minimum(n[:, 1], n[:, 2])), p["l"].str.len(), on(p["r"].str.len()), on(j - h)])

    a, b = no.toPandas(), yes.toPandas()
    model = None
    if len(a) > 20 and len(b) > 20:
        # A cut within a page was counted as the joined word by the scan itself.
        x = [x_of(a, np.zeros(len(a))), x_of(b, np.ones(len(b))), x_of(a, np.zeros(len(a)), True), x_of(b, np.ones(len(b)), True)]
        model = Boosted(np.concatenate(x), np.concatenate([np.full(len(v), k) for v, k in zip(x, (0.0, 1.0, 0.0, 1.0))]))

    def run(batches):
        for pdf in batches:
            if len(pdf):
                if model is not None:
                    p = model.predict(x_of(pdf, np.where(pdf["last"], 0.0, 1.0)))
                else:
                    p = ((pdf["n_joined"] > np.where(pdf["last"], 0, 1)) | (pdf["n_l"] < 3) | (pdf["n_r"] < 3)).astype(float)
                # Another sign is the label itself.
                yield pdf[["l", "r", "sign", "last", "n_joined"]].assign(p=np.where(pdf["sign"] != "-", 1.0, p))

    return c.mapInPandas(run, "l string, r string, sign string, last boolean, n_joined long, p double")


_LINE = ["pages", "heading", "titled", "up", "end", "width", "low", "long", "num", "bottom", "second", "opens"]


def headers(edges: DataFrame, titles: DataFrame, inner: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """edges: id, ts, book and the fields of an edge line; titles: book, skel of headings; inner: the
    same of lines from within pages. Adds p: that the line is a running title. The line and what the
    pages of its book have in the same place make the pair that is judged.

    Boosted trees learn from lines that several pages have, and from lines of the body, lines within
    pages and headings of opening pages. Half of the rows hide on how many pages the line stands, so
    that they learn what a title looks like that stands on one."""
    text = edges.where("not alone")
    # Lines that end a sentence or go on with one are of the body unless they carry a number.
    body = "(ends or lower) and not has"
    rest, text = text.where(body), text.where(f"not ({body}) and length(skel) > 3")
    per = text.groupBy("book", "skel").agg(F.count_distinct("id").alias("pages"))
    heads = titles.groupBy(F.col("book").alias("hb"), F.col("skel").alias("hs")).agg(F.count("*").alias("heads"))
    stats = per.join(heads, F.expr("book <=> hb and skel = hs"), "left").select(F.col("book").alias("b"), F.col("skel").alias("k"), "pages", F.coalesce("heads", F.lit(0).cast("long")).alias("heads"))
    # A running title may stand on a large part of a hot book's pages: its rows are spread. Lines
    # that no other page has need no partner.
    spread = stats.where("pages > 1 or heads > 0").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    t = text.withColumn("s0", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(spread, F.expr("book <=> b and skel = k and s0 = s"), "left")
    t = t.withColumn("pages", F.coalesce("pages", F.lit(1).cast("long"))).withColumn("heads", F.coalesce("heads", F.lit(0).cast("long")))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    some = lambda rows: rows.orderBy(F.xxhash64("id", "pos"), "id", "pos").limit(sample)
    boolean = lambda c: F.col(c).cast("double")
    opens = ((F.col("opening") > 0) & (F.col("pos") < 2) & ~F.col("has")).cast("double")
    shape = [
        "id", "ts", "pos", "line", "has",
        F.log1p(F.col("pages").cast("double")).alias("pages"), (F.col("heads") > 0).cast("double").alias("heading"), F.col("title").alias("titled"), boolean("upper").alias("up"), boolean("ends").alias("end"),
        "width", boolean("lower").alias("low"), F.col("n").cast("double").alias("long"), boolean("has").alias("num"), (F.col("pos") >= 2).cast("double").alias("bottom"), (F.col("pos") % 2).cast("double").alias("second"), opens.alias("opens"),
    ]
    f = materialise(t.select(*shape))
    within = lambda rows: some(rows).withColumn("pages", one).withColumn("heads", none).select(*shape)
    kinds = [(1, some(f.where((F.col("pages") > 1.5) & (F.col("opens") == 0)))), (0, within(rest)), (0, within(inner)), (0, some(f.where("opens = 1")))]
    x, y = [], []
    for label, rows in kinds:
        got = rows.select(*_LINE).toPandas().to_numpy(float)
        hidden = got.copy()
        hidden[:, 0], hidden[:, 1] = np.log1p(1.0), 0.0
        x += [got, hidden]
        y += [np.full(2 * len(got), float(label))]
    # Lines of each kind weigh as much as those of any other.
    w = np.concatenate([np.full(len(k), 1 / max(1, len(k))) for k in y])
    x, y = np.concatenate(x), np.concatenate(y)
    model = Boosted(x, y, weight=w * len(w) / w.sum()) if min((y == 1).sum(), (y == 0).sum()) > 40 else None

    def run(batches):
        for pdf in batches:
            if len(pdf):
                # Too few lines to learn from: titles that repeat or carry a number.
                rule = ((pdf["pages"] > 1) | (pdf["heading"] > 0) | (pdf["num"] > 0)) & (pdf["end"] == 0) & (pdf["low"] == 0) & (pdf["opens"] == 0)
                yield pdf[["id", "ts", "pos", "line", "has"]].assign(p=model.predict(pdf[_LINE].to_numpy(float)) if model is not None else rule.astype(float))

    return f.mapInPandas(run, "id long, ts long, pos int, line string, has boolean, p double")


class Scans:
    """The scan of a table of pages and what was decided on it.

    pages: id, ts, book, page, text, all versions; only the latest of each id is judged. A page
    without text has no noise; a NULL book is a book of its own; repeated rows are one page."""

    def __init__(self, pages: DataFrame) -> None:
        self.rows = pages
        self.scanned = materialise(scan_pages(pages))
        # Every version of a page is judged; what isn't of the latest is dropped at the end.
        self.latest = pages.groupBy("id").agg(F.max("ts").alias("ts"))
        self.vocab = materialise(vocabulary(self.scanned))
        self.words = materialise(self.vocab.groupBy("word").agg(F.sum("n").alias("n")))

    def of(self, kind: str) -> DataFrame:
        return self.scanned.where(F.col("kind") == kind)

    def current(self, found: DataFrame) -> DataFrame:
        """The rows (id, ts, ...) of latest versions, without ts."""
        now = self.latest.select(F.col("id").alias("_id"), F.col("ts").alias("_ts"))
        return found.join(now, F.expr("id = _id and ts = _ts"), "left_semi").drop("ts")

    def header_lines(self) -> DataFrame:
        """id, ts, pos, line, has of the lines that are running titles."""
        lines = lambda kind: self.of(kind).select("id", "ts", "book", "pos", F.col("a").alias("line"), F.col("c").alias("skel"), *[c for c in _EDGE if c not in ("pos", "opening")], F.col("opening").cast("int").alias("opening"))
        titles = self.of("title").select("book", F.col("c").alias("skel"))
        return headers(lines("edge"), titles, lines("inner")).where("p >= 0.5").select("id", "ts", "pos", "line", "has")

    def number_lines(self, running: DataFrame) -> DataFrame:
        """id, ts, pos, line of page numbers alone on a line or in a running title."""
        return self.of("edge").where("alone").select("id", "ts", "pos", F.col("a").alias("line")).unionByName(running.where("has").select("id", "ts", "pos", "line"))

    def cut_words(self) -> DataFrame:
        """id, ts, l, r, sign, last, nxt of words cut by an inserted hyphen; at the end of the page (last)
        r is the rest on the next page (nxt), NULL where it isn't known."""
        clean = lambda c: F.lower(F.regexp_replace(c, r"^[^\p{L}]+|[^\p{L}\p{M}]+$", ""))
        inner = self.of("cut").select("id", "ts", clean(F.col("a")).alias("l"), clean(F.col("c")).alias("r"), F.col("b").alias("sign"), F.lit(False).alias("last"), F.lit(None).cast("long").alias("nxt"))
        nxt = self.of("head").select(F.col("book").alias("bk"), (F.col("page") - 1).alias("p"), F.col("c").alias("h"), F.col("id").alias("nxt"))
        tails = self.of("tail").select("id", "ts", "book", "page", F.col("a").alias("t"), F.col("b").alias("sign"))
        ends = tails.join(nxt, F.expr("book <=> bk and page = p"), "left").select("id", "ts", clean(F.col("t")).alias("l"), clean(F.col("h")).alias("r"), "sign", F.lit(True).alias("last"), "nxt")
        every = materialise(inner.unionByName(ends).where("l <> ''").withColumn("r", F.coalesce("r", F.lit(""))))
        judged = hyphens(every.select("l", "r", "sign", "last").distinct(), self.words)
        j = judged.select(F.col("l").alias("jl"), F.col("r").alias("jr"), F.col("sign").alias("js"), F.col("last").alias("jt"), "n_joined", "p")
        j = j.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        got = every.withColumn("s0", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(j, F.expr("l = jl and r = jr and sign = js and last = jt and s0 = s"))
        # At the end of a page the first words of the next page's lines are candidates: the likeliest counts.
        best = F.max(F.struct("p", "n_joined", "r", "nxt")).alias("b")
        at_end = got.where("last").groupBy("id", "ts", "l", "sign").agg(best).where("b.p >= 0.5").select("id", "ts", "l", F.when(F.col("b.n_joined") > 0, F.col("b.r")).alias("r"), "sign", F.lit(True).alias("last"), F.col("b.nxt").alias("nxt"))
        return got.where("not last and p >= 0.5").select("id", "ts", "l", "r", "sign", "last", "nxt").unionByName(at_end)

    def misread_words(self) -> DataFrame:
        """id, ts, word, correction of misread words, from a second pass over the texts."""
        wrong = materialise(misread(self.words))
        # Bounded: the KNOWN most frequent forms of words that aren't misread.
        known = self.vocab.join(wrong.select(F.col("word").alias("mw")), F.col("word") == F.col("mw"), "left_anti").orderBy(F.desc("n"), "raw").limit(KNOWN).select("raw")
        seen = self.rows.sparkSession.sparkContext.broadcast(frozenset(known.toPandas()["raw"]))

        def run(batches):
            skip = seen.value
            for pdf in batches:
                if not len(pdf):
                    continue
                rare = []
                for t in pdf["text"]:
                    if t is None:
                        rare.append([])
                        continue
                    rare.append(sorted({b for x in forms_of(t) - skip if (b := bare(x))}))
                yield pd.DataFrame({"id": pdf["id"], "ts": pdf["ts"], "rare": rare})

        found = self.rows.select("id", "ts", "text").mapInPandas(run, "id long, ts long, rare array<string>")
        each = found.where(F.size("rare") > 0).select("id", "ts", F.explode("rare").alias("word"))
        w = wrong.select(F.col("word").alias("ww"), "correction", "p").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return each.withColumn("s0", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(w, F.expr("word = ww and s0 = s")).select("id", "ts", "word", "correction", "p")

    def noise(self) -> DataFrame:
        """id, noise: one row for each page and kind of noise."""
        running = materialise(self.header_lines())
        kinds = [(self.cut_words(), "hyphen"), (self.misread_words(), "misread"), (running, "header"), (self.number_lines(running), "page_number")]
        out = None
        for df, k in kinds:
            part = df.select("id", "ts", F.lit(k).alias("noise"))
            out = part if out is None else out.unionByName(part)
        return self.current(out.distinct()).distinct()

    def cleaned(self) -> DataFrame:
        """id, text: the pages as continuous paragraphs without their noise."""
        running = materialise(self.header_lines())
        drop = self.current(running.select("id", "ts", "line").unionByName(self.number_lines(running).select("id", "ts", "line"))).groupBy("id").agg(F.collect_set("line").alias("drop"))
        every = materialise(self.cut_words().where("r is not null"))
        # A word that goes on on the next page is completed where it begins and taken off there.
        over = self.current(every.where("last").select("id", "ts", "l", "r", "nxt"))
        tail = over.groupBy("id").agg(F.min(F.concat_ws("\u0000", "l", "r")).alias("tail"))
        head = over.where("nxt is not null").groupBy(F.col("nxt").alias("id")).agg(F.min("r").alias("head"))
        cuts = self.current(every.where("not last").select("id", "ts", "l", "r")).groupBy("id").agg(F.collect_set(F.concat_ws("\u0000", "l", "r")).alias("cuts"))
        fix = self.current(self.misread_words()).groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("word", "correction"))).alias("fix"))
        texts = latest(self.rows, ["id"], F.col("ts"), ["id", "text"])

        def run(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                yield pd.DataFrame({"id": pdf["id"], "text": [None if t is None else clean(t, set(d if d is not None else ()), set(c if c is not None else ()), dict(f if f is not None else ()), a, b) for t, d, c, f, a, b in zip(pdf["text"], pdf["drop"], pdf["cuts"], pdf["fix"], pdf["tail"], pdf["head"])]})

        for more in (drop, cuts, fix, tail, head):
            texts = texts.join(more, "id", "left")
        return texts.select("id", "text", "drop", "cuts", "fix", "tail", "head").mapInPandas(run, "id long, text string")


def clean(text: str, drop: set[str], cuts: set[str], fix: dict[str, str], tail: str | None = None, head: str | None = None) -> str:
    """One page: furniture taken off, cut words joined, misread words corrected, lines run on.

    tail: a word cut at the end of the page and its rest; head: a rest that belongs to the page before."""
    lines = text.replace("\r\n", "\n").split("\n")
    full = [i for i, x in enumerate(lines) if x.strip()]
    for i in {*full[:2], *full[-2:]}:
        if lines[i].strip() in drop:
            lines[i] = ""
    edge = re.compile(r"^[^\w]+|[^\w]+$")
    body = [i for i, x in enumerate(lines) if x.strip()]
    if body and isinstance(tail, str):
        left, _, right = tail.partition("\0")
        m = _TAIL.search(lines[body[-1]])
        if m and edge.sub("", m[1]).lower() == left:
            lines[body[-1]] = lines[body[-1]][: m.start(2)] + right
    if body and isinstance(head, str):
        first, *rest = lines[body[0]].strip().split(None, 1)
        if edge.sub("", first).lower() == head:
            lines[body[0]] = rest[0] if rest else ""

    def join(m: re.Match) -> str:
        key = edge.sub("", m[1]).lower() + "\0" + edge.sub("", m[3]).lower()
        # That the whole is a misread word says as well that the hyphen was inserted.
        return m[1] + m[3] if key in cuts or bare(m[1] + m[3]) in fix else m[1] + m[2] + m[3]

    body = _BROKEN.sub(join, "\n".join(lines).strip())
    paragraphs = [" ".join(x.split()) for x in re.split(r"\n\s*\n", body)]

    def word(m: re.Match) -> str:
        t = m[0]
        b = bare(t)
        if b not in fix:
            return t
        i = t.lower().find(b)
        new = fix[b]
        new = new.upper() if t[i : i + len(b)].isupper() and len(b) > 1 else new.capitalize() if t[i : i + 1].isupper() else new
        return t[:i] + new + t[i + len(b) :]

    return "\n\n".join(re.sub(r"\S+", word, p) if fix else p for p in paragraphs if p)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "content")
    return c.select(F.col("content_id").alias("id"), recency("content").alias("ts"), F.col("book_id").cast("long").alias("book"), F.col("page_number").cast("long").alias("page"), F.col("page_content").alias("text"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Scans(_pages(spark, sf_dir)).noise().select(F.col("id").alias("content_id"), "noise")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as continuous paragraphs without noise."""
    return Scans(_pages(spark, sf_dir)).cleaned().select(F.col("id").alias("content_id"), "text")


QUERIES = {"p4_found": p4_found, "p4_clean": p4_clean}
ORACLE: dict[str, str] = {}

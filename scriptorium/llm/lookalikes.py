"""One consistent form for text that looks the same but differs in its characters.

Values with any suspicious character (a look-alike, an invisible sign, a combining mark, a second
script) are taken apart into words, and these are matched against the vocabulary of all plain words,
in every script: tries over it are walked by a weighted edit automaton in which look-alikes,
compositions and ignorable signs cost nothing, letters that are merely alike something, and anything
else more than allowed. Of the spellings reached at least cost the most frequent is taken; so the
vocabulary decides which script a mixed word belongs to and which of several readings a letter has.
A word that reaches none is normalised by the tables alone. Words meet in shards by a skeleton that
no step of the automaton changes.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from ..tables import current

# Signs that show nothing.
IGNORABLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
# Spaces and hyphens other than the plain ones.
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\u2043\u2212\ufe63\uff0d"
# Cyrillic and Greek letters that look like Latin ones.
TO_LATIN = dict(
    zip(
        "асԁеһіјӏорԛѕухԝАВСЕНІЈКМОРЅТХҮУ" "αινορυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "acdehijlopqsyxwABCEHIJKMOPSTXYY" "aivopuABEZHIKMNOPTYX",
    )
)
TO_CYRILLIC = {v: k for k, v in TO_LATIN.items() if "Ѐ" <= k <= "ԯ" and k != "У"}
TO_GREEK = {v: k for k, v in TO_LATIN.items() if "Ͱ" <= k <= "Ͽ"}

#: Values made of these alone are in the consistent form; all others are looked at one by one.
PLAIN = r"^[\x20-\x7e\u00a1-\u00ac\u00ae-\u024f\u1e00-\u1eff\u2013\u2014\u2018\u2019\u201c\u201d]*$"
#: Shows anything at all.
_SHOWN = r"(?U)[^\s" + "".join(f"\\x{{{ord(c):x}}}" for c in IGNORABLE) + "]"
SHARD_ROWS = 50_000  # words tried in one task, about
SALTS = 8
WEAK = 0.5  # cost of a letter that is merely alike; look-alikes cost nothing
LIMIT = 1.0  # what a spelling may cost
# Cyrillic and Greek letters that are merely like Latin ones.
ALIKE = (
    [("к", "k"), ("κ", "k"), ("м", "m"), ("т", "t"), ("τ", "t"), ("н", "h"), ("г", "r"), ("п", "n"), ("η", "n"), ("и", "u"), ("μ", "u"), ("ш", "w"), ("ω", "w"), ("χ", "x"), ("γ", "y"), ("ь", "b"), ("в", "b"), ("β", "b")]
    + [("з", "3"), ("б", "6"), ("ε", "e"), ("є", "e"), ("σ", "o"), ("ν", "n"), ("υ", "v"), ("ι", "l"), ("ӏ", "I"), ("П", "N"), ("Г", "T"), ("Ш", "W"), ("Ω", "O"), ("Σ", "E"), ("И", "N"), ("Я", "R")]
)

_WORD = re.compile(r"[^ \-]+")
_FLAT = str.maketrans({**{c: " " for c in SPACES}, **{c: "-" for c in HYPHENS}, **{chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F) if chr(c) not in HYPHENS}})


def _script(c: str) -> str:
    o = ord(c)
    if c.isascii():
        return "L" if c.isalpha() else ""
    if 0x400 <= o <= 0x52F:
        return "C"
    if 0x370 <= o <= 0x3FF:
        return "G"
    if c.isalpha():
        return "L" if o < 0x250 or 0x1E00 <= o <= 0x1EFF else "O"
    return ""


def choices(word: str) -> dict[str, str]:
    """Zero-cost replacements of letters inside one word: those of a foreign script that look like
    the word's own. A word wholly in one script has none."""
    kinds = {_script(c) for c in word} - {""}
    if not ({"C", "G"} & kinds) or len(kinds) < 2:
        return {}
    alien = {c for c in word if _script(c) in "CG"}
    if alien <= TO_LATIN.keys():
        return {c: TO_LATIN[c] for c in alien}
    own = "C" if sum(_script(c) == "C" for c in word) >= sum(_script(c) == "G" for c in word) else "G"
    table = TO_CYRILLIC if own == "C" else TO_GREEK
    latin = {c for c in word if _script(c) == "L"}
    if latin <= table.keys():
        return {c: table[c] for c in latin}
    return {c: TO_LATIN[c] for c in alien & TO_LATIN.keys()}


def mixed(word: str) -> bool:
    """Letters of Cyrillic or Greek beside those of another script."""
    kinds = {_script(c) for c in word} - {""}
    return bool({"C", "G"} & kinds) and len(kinds) > 1


def _steps() -> dict[str, list[tuple[str, float]]]:
    """What the automaton may read for a letter of a mixed word, either way, and its cost."""
    out: dict[str, dict[str, float]] = {}
    for cost, pairs in ((WEAK, ALIKE), (0.0, TO_LATIN.items())):
        for a, b in pairs:
            out.setdefault(a, {})[b] = cost
            out.setdefault(b, {})[a] = cost
    # Cyrillic and Greek letters that look like the same Latin one look like each other.
    for a, b in TO_LATIN.items():
        for c, d in TO_LATIN.items():
            if b == d and a != c:
                out[a][c] = 0.0
    return {k: list(v.items()) for k, v in out.items()}


STEPS = _steps()


def _classes() -> dict[str, str]:
    """Every letter's class: letters that lead to each other by any steps share one."""
    root: dict[str, str] = {}

    def top(c: str) -> str:
        while root.get(c, c) != c:
            c = root[c]
        return c

    for a, steps in STEPS.items():
        for b, _ in steps:
            lo, hi = sorted((top(a), top(b)))
            root[hi] = lo
    return {c: top(c) for c in STEPS}


_CLASS = _classes()
#: The same for the composed letters of plain values, so that the JVM can fold them: base, then class.
_COMPOSED = {chr(o): _CLASS.get(d[0], d[0]) for lo, hi in ((0xC0, 0x250), (0x1E00, 0x1F00)) for o in range(lo, hi) if len(d := unicodedata.normalize("NFD", chr(o))) > 1}
_FOLD = {**_COMPOSED, **{c: k for c, k in _CLASS.items() if c != k}}


def skeleton(word: str) -> str:
    """Letters without marks, each by its class; no step of the automaton changes it."""
    return "".join(_CLASS.get(c, c) for c in unicodedata.normalize("NFD", bare(word)) if not unicodedata.combining(c))


def skeleton_of(word):
    """The same of a column of plain words."""
    return F.translate(word, "".join(_FOLD), "".join(_FOLD.values()))


def _keep_joiner(s: str, i: int) -> bool:
    """Joiners belong to Indic words: after a virama or between Indic letters."""
    return s[i] in "\u200c\u200d" and 0 < i and 0x900 <= ord(s[i - 1]) <= 0xDFF and i + 1 < len(s) and 0x900 <= ord(s[i + 1]) <= 0xDFF


def bare(value: str) -> str:
    """The value with plain spaces, hyphens and widths and without ignorable signs."""
    s = value.translate(_FLAT)
    return "".join(c for i, c in enumerate(s) if c not in IGNORABLE or _keep_joiner(s, i))


def normal(value: str) -> str:
    """The consistent form by the tables alone (not trimmed)."""
    s = _WORD.sub(lambda m: "".join(map(lambda c, t=choices(m[0]): t.get(c, c), m[0])), bare(value))
    return unicodedata.normalize("NFC", s)


class Trie:
    """Trie of plain words with their counts."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, n: int) -> None:
        at = self.root
        for c in word:
            at = at.setdefault(c, {})
        at[""] = (word, n)

    def match(self, word: str) -> str | None:
        """The spelling reached at least cost, of several the most frequent; None: none within LIMIT.

        A state is a node of the trie and what was spent on the way to it. Ignorable signs are
        passed over, a base with its marks steps along the composed letter or along both, and in a
        word of mixed scripts a letter steps along those it looks like as well."""
        s = unicodedata.normalize("NFD", bare(word))
        steps = STEPS if mixed(s) else {}
        states: dict[int, tuple[dict, float]] = {id(self.root): (self.root, 0.0)}
        i = 0
        while i < len(s) and states:
            j = i + 1
            while j < len(s) and unicodedata.combining(s[j]):
                j += 1
            nxt: dict[int, tuple[dict, float]] = {}
            for c, cost in ((s[i], 0.0), *steps.get(s[i], ())):
                raw = c + s[i + 1 : j]
                for form in {raw, unicodedata.normalize("NFC", raw)}:
                    for at, spent in states.values():
                        for x in form:
                            at = at.get(x)
                            if at is None:
                                break
                        if at is not None and spent + cost <= min(LIMIT, nxt.get(id(at), (at, LIMIT))[1]):
                            nxt[id(at)] = (at, spent + cost)
            states, i = nxt, j
        ends = [(-spent, *reversed(at[""])) for at, spent in states.values() if "" in at]
        return max(ends)[2] if ends else None


def words_of(values: DataFrame) -> DataFrame:
    """values: value, n (different values with suspicious characters). Returns word, n, odd, skel of
    their words as they stand; odd: the word isn't in a consistent form."""

    def run(batches):
        for pdf in batches:
            seen: Counter = Counter()
            for v, n in zip(pdf["value"], pdf["n"]):
                for w in set(_WORD.findall(v.translate(_FLAT))):
                    seen[w] += n
            if seen:
                odd = [mixed(w) or w != normal(w) for w in seen]
                yield pd.DataFrame({"word": list(seen), "n": list(seen.values()), "odd": odd, "skel": [skeleton(w) for w in seen]})

    return values.select("value", "n").mapInPandas(run, "word string, n long, odd boolean, skel string").groupBy("word", "odd", "skel").agg(F.sum("n").alias("n"))


def spellings(odd: DataFrame, vocabulary: DataFrame, shards: int) -> DataFrame:
    """odd: word, skel. vocabulary: word, n, skel. Returns word, spelling of all odd words that reach
    one of the vocabulary. A shard's tries are built one skeleton at a time."""
    wanted = odd.select("skel").distinct()
    met = vocabulary.join(wanted, "skel", "left_semi").groupBy("word", "skel").agg(F.sum("n").alias("n"))
    both = odd.select("word", "skel", F.lit(0).cast("long").alias("n"), F.lit(True).alias("odd")).unionByName(met.withColumn("odd", F.lit(False)))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.groupby("skel", sort=False):
            flags = g["odd"].to_numpy()
            if not flags.any() or flags.all():
                continue
            trie = Trie()
            for w, n in zip(g["word"][~flags], g["n"][~flags]):
                trie.add(w, int(n))
            out += [(w, got) for w in g["word"][flags] if (got := trie.match(w)) is not None]
        return pd.DataFrame(out, columns=["word", "spelling"]).astype(object)

    return both.withColumn("shard", F.pmod(F.xxhash64("skel"), F.lit(shards))).groupBy("shard").applyInPandas(solve, "word string, spelling string")


def canonical(values: DataFrame, *, shards: int | None = None) -> DataFrame:
    """values: value string, n bigint (distinct values with counts). Returns value, canonical of
    the values that have suspicious characters; all others are their own canonical form.

    NULL and blank values are left out. Canonical forms have the white space at their ends. Values
    are put together again from their words, each of which has one spelling.
    """
    v = materialise(values.where(F.col("value").rlike(_SHOWN)).withColumn("plain", F.col("value").rlike(PLAIN)))
    odd = v.where("not plain").select("value", "n")
    own = materialise(words_of(odd))
    plain = v.where("plain").select(F.explode(F.split("value", r"[ \-]+")).alias("word"), "n").where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = plain.select("word", "n", skeleton_of(F.col("word")).alias("skel")).unionByName(own.where("not odd").select("word", "n", "skel"))
    todo = own.where("odd").select("word", "skel")
    if shards is None:
        shards = max(16, todo.count() // SHARD_ROWS)
    found = spellings(todo, vocabulary, shards)
    flat = F.translate("value", "".join(map(chr, _FLAT)), "".join(_FLAT.values()))
    each = odd.select("value", F.explode(F.array_distinct(F.split(flat, r"[ \-]+"))).alias("w"))
    # One row for each word of a value: as many as the value has.
    maps = each.join(found, F.col("w") == F.col("word")).groupBy("value").agg(F.map_from_entries(F.collect_list(F.struct("w", "spelling"))).alias("put"))

    def run(batches):
        for pdf in batches:
            if len(pdf):
                new = []
                for x, put in zip(pdf["value"], pdf["put"]):
                    known = dict(put) if put is not None else {}
                    new.append(_WORD.sub(lambda m: known.get(m[0]) or normal(m[0]), x.translate(_FLAT)))
                yield pd.DataFrame({"value": pdf["value"], "canonical": new})

    return odd.join(maps, "value", "left").select("value", "put").mapInPandas(run, "value string, canonical string")


def apply(rows: DataFrame, *, shards: int | None = None) -> DataFrame:
    """rows: src_table, row_id, value. Adds canonical (trimmed) and changed: whether the value is
    altered other than by trimming. NULL and blank values stay as they are. Other
    columns have no effect."""
    rows = rows.select("src_table", "row_id", "value")
    odd = rows.where(~F.col("value").rlike(PLAIN))
    mapping = canonical(rows.groupBy("value").agg(F.count("*").alias("n")), shards=shards)
    spread = mapping.select(F.col("value").alias("_v"), "canonical", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    done = odd.withColumn("_s0", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int")).join(spread, F.expr("value = _v and _s0 = _s"), "left")
    done = done.select("src_table", "row_id", "value", F.trim(F.coalesce("canonical", "value")).alias("canonical"), F.coalesce(F.col("canonical") != F.col("value"), F.lit(False)).alias("changed"))
    same = rows.where(F.coalesce(F.col("value").rlike(PLAIN), F.lit(True))).select("src_table", "row_id", "value", F.trim("value").alias("canonical"), F.lit(False).alias("changed"))
    return same.unionByName(done)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [("pbb_word_bank", "word_id", "raw_word"), ("ambiguous_diacritic_words", "id", "word"), ("glossary", "glossary_id", "term")]
    out = None
    for table, key, col in parts:
        part = current(spark, sf_dir, table, [key, col]).select(F.lit(table).alias("src_table"), F.col(key).alias("row_id"), F.col(col).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def p7_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its consistent form."""
    return apply(_rows(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply(_rows(spark, sf_dir)).where("changed").select("src_table", "row_id")


QUERIES = {"p7_canonical": p7_canonical, "p7_found": p7_found}
ORACLE: dict[str, str] = {}

"""Repair of transliterated words stored in legacy font glyphs, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digraphs, then single glyphs, and what they stand for, in order of application.
DIGRAPHS = (("åñ", "ṛṣ"), ("Åñ", "Ṛṣ"), ("ÅÑ", "ṚṢ"))
PAIRS = [
    ("ä", "ā"), ("Ä", "Ā"), ("é", "ī"), ("É", "Ī"), ("ü", "ū"), ("Ü", "Ū"), ("î", "ī"), ("Î", "Ī"), ("ë", "ṇ"), ("Ë", "Ṇ"), ("√", "ṇ"),
    ("ö", "ṭ"), ("Ö", "Ṭ"), ("ò", "ḍ"), ("Ò", "Ḍ"), ("∂", "ḍ"), ("∫", "ṅ"), ("ì", "ṅ"), ("Ì", "Ṅ"), ("ç", "ś"), ("Ç", "Ś"), ("ß", "ṣ"),
    ("®", "ṛ"), ("µ", "ṁ"), ("ù", "ḥ"), ("Ù", "Ḥ"), ("†", "ṭ"), ("ˇ", "Ṭ"), ("à", "ṁ"), ("À", "Ṁ"), ("ï", "ñ"), ("Ï", "Ñ"),
]
# The maps of single words: the first knows no å and ñ, the second takes å for ṛ.
WORD_PAIRS = [
    ("ä", "ā"), ("Ä", "Ā"), ("é", "ī"), ("É", "Ī"), ("ë", "ṇ"), ("Ë", "Ṇ"), ("ï", "ñ"), ("Ï", "Ñ"), ("ö", "ṭ"), ("Ö", "Ṭ"), ("ü", "ū"), ("Ü", "Ū"), ("ò", "ḍ"), ("Ò", "Ḍ"), ("ç", "ś"), ("Ç", "Ś"),
    ("ß", "ṣ"), ("î", "ī"), ("Î", "Ī"), ("®", "ṛ"), ("µ", "ṁ"), ("√", "ṇ"), ("∂", "ḍ"), ("∫", "ṅ"), ("ù", "ḥ"), ("Ù", "Ḥ"), ("†", "ṭ"),
]
SAMPLE_PAIRS = [*WORD_PAIRS, ("å", "ṛ"), ("Å", "Ṛ")]
# Letters of words and of valid transliteration.
IAST = "aāiīuūṛṝḷḹeoṁṃḥkgṅcjñṭḍṇtdnpbmyrlvśṣsh"
LETTERS = "A-Za-zāīūṛṝḷḹēōṁṃḥṅñṭḍṇśṣåĀĪŪṚṜḶḸĒŌṀṂḤṄÑṬḌṆŚṢÅ"
# Contexts in which å stands for ṛ, in order (Java form).
A_RULES = [
    ("åh", "ṛh"), ("åḥ", "ṛḥ"), ("([^āīū])amåt", "$1amṛt"), ("^amåt", "amṛt"), ("([āīū])måt", "$1mṛt"), ("småt", "smṛt"), ("gåhī", "gṛhī"), ("tåpt", "tṛpt"), ("tåṇ", "tṛṇ"),
    ("dåḍh", "dṛḍh"), ("dåśy", "dṛśy"), ("prakåt", "prakṛt"), ("^kåt([aeiumoāīū])", "kṛt$1"), ("([^i])kåt([aeiumoāīū])", "$1kṛt$2"), ("vånd", "vṛnd"), ("dhåtr", "dhṛtar"), ("^dhåt", "dhṛt"),
    ("([^i])dhåt", "$1dhṛt"), ("bhåg", "bhṛg"), ("håda", "hṛda"), ("å", "ā"),
]
# Tags of corrections (left side before, right side after).
TAGS = [
    ("ñṇ", "ṣṇ"), ("viñ", "viṣ"), ("kñ", "kṣ"), ("rña", "rṣa"), ("ñṭ", "ṣṭ"), ("ñeka", "ṣeka"), ("śiñya", "śiṣya"), ("ñya", "ṣya"), ("ñma", "ṣma"), ("åh", "ṛh"), ("amåt", "amṛt"), ("småt", "smṛt"),
    ("gåhī", "gṛhī"), ("tåpt", "tṛpt"), ("tåṇ", "tṛṇ"), ("dåḍh", "dṛḍh"), ("dåśy", "dṛśy"), ("prakåt", "prakṛt"), ("kåt", "kṛt"), ("vånd", "vṛnd"), ("dhåt", "dhṛt"),
]
TOKEN = rf"[{LETTERS}\-]+|\s+|[^\s\w]+|\d+|."


def map_glyphs(text: Column) -> Column:
    """Legacy glyphs to transliteration: the digraphs, then all single glyphs in one pass."""
    t = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), DIGRAPHS, text)
    return F.translate(t, "".join(a for a, _ in PAIRS), "".join(b for _, b in PAIRS))


def map_words(words: Column, pairs: list[tuple[str, str]]) -> Column:
    """A list of words, each with its glyphs replaced by one of the maps for single words."""
    return F.transform(words, lambda w: F.translate(w, "".join(a for a, _ in pairs), "".join(b for _, b in pairs)))


def glyph_count(text: Column, glyph: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(glyph), F.lit("")))


def fix_n(w: Column) -> Column:
    """ñ of a lower-case word to ṣ, but in jñ, ñc and, after a vowel, ñj."""
    w = F.replace(F.replace(w, F.lit("jñ"), F.lit("\x01")), F.lit("ñc"), F.lit("\x02"))
    w = F.regexp_replace(w, "([aāiīuūṛeēoō])ñj", "$1\x03")
    w = F.replace(w, F.lit("ñ"), F.lit("ṣ"))
    return F.replace(F.replace(F.replace(w, F.lit("\x01"), F.lit("jñ")), F.lit("\x02"), F.lit("ñc")), F.lit("\x03"), F.lit("ñj"))


def fix_a(w: Column) -> Column:
    """å of a lower-case word to ṛ in known contexts, else to ā."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), A_RULES, w)


def case_pattern(w: Column) -> Column:
    """upper, lower, title (first letter alone is a capital) or mixed; no letters: lower."""
    letters = F.regexp_replace(w, r"[^\p{L}]", "")
    return F.when(letters == F.lower(letters), "lower").when(letters == F.upper(letters), "upper").when(letters == F.concat(F.upper(F.substring(letters, 1, 1)), F.lower(F.substr(letters, F.lit(2)))), "title").otherwise("mixed")


def restore_case(fixed: Column, original: Column) -> Column:
    """Case of the original on the corrected word; mixed case letter by letter."""
    letters = F.regexp_replace(original, r"[^\p{L}]", "")
    state = F.struct(F.lit(1).alias("i"), F.lit("").alias("o"))

    def step(s: Column, c: Column) -> Column:
        letter = c.rlike(r"\p{L}")
        ref = F.substr(letters, s["i"], F.lit(1))
        cased = F.when(~letter | (s["i"] > F.length(letters)), c).when(ref == F.lower(ref), F.lower(c)).otherwise(F.upper(c))
        return F.struct(F.when(letter, s["i"] + 1).otherwise(s["i"]).alias("i"), F.concat(s["o"], cased).alias("o"))

    mixed = F.aggregate(F.split(fixed, ""), state, step, lambda s: s["o"])
    p = case_pattern(original)
    return F.when(p == "upper", F.upper(fixed)).when(p == "lower", F.lower(fixed)).when(p == "title", F.concat(F.upper(F.substring(fixed, 1, 1)), F.lower(F.substr(fixed, F.lit(2))))).otherwise(mixed)


def fix_word(w: Column) -> Column:
    """One word: ñ rule, then å rule, on its lower-case form; its case is restored."""
    return F.when(w.rlike("[ñÑåÅ]"), restore_case(fix_a(fix_n(F.lower(w))), w)).otherwise(w)


def word_class(w: Column) -> Column:
    n, a = F.regexp_count(F.lower(w), F.lit("ñ")), F.regexp_count(F.lower(w), F.lit("å"))
    return F.when((n > 0) & (a > 0), "BOTH").when(n > 1, "MULTIPLE_N").when(a > 1, "MULTIPLE_A").when(n == 1, "SINGLE_N").when(a == 1, "SINGLE_A").otherwise("CLEAN")


def validated(before: Column, after: Column, confidence: Column) -> dict[str, Column]:
    """Errors and warnings of a correction, and its confidence after them. A warning stands for a
    length that changed by more than two, and one for every letter of no transliteration."""
    low = F.lower(after)
    error = F.regexp_replace(low, "jñ|ñc|ñj", "").contains("ñ") | low.contains("å")
    long = F.when(F.abs(F.length(after) - F.length(before)) > 2, 1).otherwise(0)
    foreign = F.regexp_count(F.regexp_replace(low, rf"[{IAST}]", ""), F.lit(r"\p{L}"))
    warning = long + foreign > 0
    c = F.round(confidence * F.when(error, 0.7).otherwise(1.0) * F.when(warning, 0.9).otherwise(1.0), 6)
    return {"error": error, "warning": warning, "confidence": c, "review": c < 0.90, "warnings": (long + foreign).cast("int")}


def fix_text(text: Column) -> Column:
    """A whole page: glyph map, then every word token by rule; NULL and empty stay."""
    tokens = F.regexp_extract_all(map_glyphs(text), F.lit("(?Us)" + TOKEN), F.lit(0))
    return F.when(text.isNull() | (text == ""), text).otherwise(F.array_join(F.transform(tokens, lambda t: fix_word(t)), ""))


def words_of(pages: DataFrame, text: str) -> DataFrame:
    """Word tokens of pages after the glyph map, one row each."""
    tokens = F.regexp_extract_all(map_glyphs(F.col(text)), F.lit("(?Us)" + TOKEN), F.lit(0))
    return pages.withColumn("word", F.explode(tokens)).where(F.col("word").rlike(rf"^[{LETTERS}\-]+$"))


def corrections(words: DataFrame) -> DataFrame:
    """word, n to class, corrected, tags, error, warning, confidence, review; one row per word."""
    c = words.withColumn("class", word_class(F.col("word"))).withColumn("corrected", fix_word(F.col("word")))
    base = F.when(F.col("class") == "CLEAN", 1.0).when(F.col("class").startswith("SINGLE"), 0.99).otherwise(0.95)
    low_b, low_a = F.lower("word"), F.lower("corrected")
    tags = F.array_join(F.filter(F.array(*[F.when(low_b.contains(x) & low_a.contains(y), f"{x}→{y}") for x, y in TAGS]), lambda x: x.isNotNull()), " ")
    v = validated(F.col("word"), F.col("corrected"), base)
    changed = F.col("word") != F.col("corrected")
    return c.select("word", "n", "class", "corrected", F.when(changed, tags).otherwise("").alias("tags"), *[x.alias(k) for k, x in v.items()])


def page_statistics(pages: DataFrame, key: str, text: str) -> DataFrame:
    """Words, corrected words, words of each class and words to review, per page.

    All is computed on the page's own words: nothing is shuffled but a row of counts, and none where
    keys don't repeat. Words without å and ñ need no correction, have no errors and no review."""
    # Of the tokens only words are kept as they are read; the others come as ''.
    tokens = F.regexp_extract_all(map_glyphs(F.col(text)), F.lit(rf"(?Us)([{LETTERS}\-]+)|" + TOKEN.split("|", 1)[1]), F.lit(1))
    p = pages.select(key, F.filter(tokens, lambda t: t != "").alias("_w"))
    p = p.select(key, F.size("_w").cast("long").alias("words"), F.filter("_w", lambda t: t.contains("ñ") | t.contains("å") | t.contains("Ñ") | t.contains("Å")).alias("_d"))

    # What several measures need of a word is worked out once, by a transform of its own.
    fixed = lambda w: F.struct(w.alias("w"), word_class(w).alias("c"), fix_word(w).alias("after"))

    def judged(x: Column) -> Column:
        v = validated(x["w"], x["after"], F.when(x["c"].startswith("SINGLE"), 0.99).otherwise(0.95))
        return F.struct(x["c"].alias("c"), (x["w"] != x["after"]).alias("changed"), v["confidence"].alias("confidence"), v["error"].alias("error"))

    p = p.where("words > 0").select(key, "words", F.transform(F.transform("_d", fixed), judged).alias("_j"))
    n = lambda f: F.size(F.filter("_j", f)).cast("long")
    of = lambda kind: n(lambda x: x["c"] == kind).alias(kind.lower())
    p = p.select(
        key, "words", n(lambda x: x["changed"]).alias("corrected"), (F.col("words") - F.size("_j")).cast("long").alias("clean"),
        *[of(k) for k in ("SINGLE_N", "SINGLE_A", "BOTH", "MULTIPLE_N", "MULTIPLE_A")], n(lambda x: x["confidence"] < 0.90).alias("review"), n(lambda x: x["error"]).alias("errors"),
    )
    return p.groupBy(key).agg(*[F.sum(c).alias(c) for c in p.columns if c != key])

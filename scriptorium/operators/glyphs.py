"""Statistics of glyphs, words and fonts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

# Glyphs of legacy fonts.
GLYPHS = "åäëéïöüúùÿçîòµß®√∂∫†ñ"
UPPER = "ÅÄËÉÏÖÜÚÙŸÇÎÒÑ"
WORD = r"[A-Za-zāīūṛṝṣśṅñṁḥḍṭṇḷĀĪŪṚṢŚṄÑṀḤḌṬṆäåçéëïöüìùòàúÿîßµ®√∂∫†ÄÅÇÉËÏÖÜÌÙÒÀÚÎ'\-]+"
DEVANAGARI = r"[ऀ-ॿ]"


def glyph_words(pages: DataFrame, glyphs: str = GLYPHS + UPPER, most_pages: int = 20, most_words: int = 50) -> DataFrame:
    """Per book and glyph: words with it, the first pages and the first different words in reading
    order, both bounded.

    Bounded lists are ranks over aggregated rows, so no group is collected whole."""
    w = pages.select("book_id", "page_number", F.posexplode(F.regexp_extract_all("page_content", F.lit(WORD), F.lit(0))).alias("pos", "word"))
    hit = w.where(F.col("word").rlike(f"[{glyphs}]")).withColumn("glyph", F.explode(F.array_distinct(F.regexp_extract_all("word", F.lit(f"[{glyphs}]"), F.lit(0)))))
    key = ["book_id", "glyph"]
    total = hit.groupBy(*key).agg(F.count("*").alias("n"))
    page = hit.select(*key, "page_number").distinct().withColumn("k", F.row_number().over(W.partitionBy(*key).orderBy("page_number"))).where(F.col("k") <= most_pages).groupBy(*key).agg(F.array_sort(F.collect_list("page_number")).alias("pages"))
    first = hit.groupBy(*key, "word").agg(F.min(F.struct("page_number", "pos")).alias("at")).withColumn("k", F.row_number().over(W.partitionBy(*key).orderBy("at", "word"))).where(F.col("k") <= most_words)
    words = first.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "word"))), lambda x: x["word"]).alias("words"))
    return total.join(page, key).join(words, key).select("book_id", "glyph", "n", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"), F.array_join("words", ",").alias("words"))


def glyph_summary(records: DataFrame) -> DataFrame:
    """Per font, glyph and code point: occurrences, number and list of books and all different sample
    words, in order.

    Words and books are made different before they are listed, so a list is as long as the result."""
    key = ["font_name", "glyph", "unicode_codepoint"]
    total = records.groupBy(*key).agg(F.sum("occurrence_count").alias("total"))
    books = records.where("book_id is not null").select(*key, "book_id").distinct().groupBy(*key).agg(F.count("*").alias("books"), F.array_join(F.array_sort(F.collect_list("book_id")).cast("array<string>"), ",").alias("book_ids"))
    words = records.select(*key, F.explode("sample_words").alias("w")).where("w is not null").distinct().groupBy(*key).agg(F.count("*").alias("n_words"), F.array_join(F.array_sort(F.collect_list("w")), "|").alias("words"))
    none = F.lit(0).cast("long")
    same = lambda d, p: [F.col(c).eqNullSafe(F.col(f"_{p}{c}")) for c in key]
    mark = lambda d, p: d.select(*[F.col(c).alias(f"_{p}{c}") for c in key], *[c for c in d.columns if c not in key])
    out = total.join(mark(books, "b"), same(books, "b"), "left").join(mark(words, "w"), same(words, "w"), "left")
    return out.select(*key, "total", F.coalesce("books", none).alias("books"), F.coalesce("book_ids", F.lit("")).alias("book_ids"), F.coalesce("n_words", none).alias("n_words"), F.coalesce("words", F.lit("")).alias("words"))


def top(records: DataFrame, by: str, n: int = 5) -> DataFrame:
    """The n values with most occurrences; ties by value."""
    return records.groupBy(by).agg(F.sum("occurrence_count").alias("total")).orderBy(F.desc_nulls_last("total"), by).limit(n)


def char_glyphs(pages: DataFrame, allowed: str) -> DataFrame:
    """Per book and character outside the allowed set: occurrences and first page."""
    c = pages.select("book_id", "page_number", F.explode(F.regexp_extract_all("page_content", F.lit(f"[^{allowed}]"), F.lit(0))).alias("char"))
    return c.groupBy("book_id", "char").agg(F.count("*").alias("n"), F.count_distinct("page_number").alias("pages"), F.min("page_number").alias("first_page"))


def char_contexts(pages: DataFrame, allowed: str, most: int = 20) -> DataFrame:
    """Per book and character outside the allowed set: how often it occurs, its first pages and the
    first different words around it, at most ``most`` of each.

    Words are counted before they are ranked, so a frequent character brings one row a word."""
    delimiters = r" \n\r\t.,;:!?()\[\]{}"
    w = pages.select("book_id", "page_number", F.posexplode(F.regexp_extract_all("page_content", F.lit(f"[^{delimiters}]+"), F.lit(0))).alias("pos", "word"))
    hit = w.where(F.col("word").rlike(f"[^{allowed}]")).select("book_id", "page_number", "pos", "word", F.explode(F.regexp_extract_all("word", F.lit(f"[^{allowed}]"), F.lit(0))).alias("char"))
    key = ["book_id", "char"]
    per = hit.groupBy(*key, "word", "page_number").agg(F.count("*").alias("n"), F.min("pos").alias("pos"))
    total = per.groupBy(*key).agg(F.sum("n").alias("n"))
    page = per.select(*key, "page_number").distinct().withColumn("k", F.row_number().over(W.partitionBy(*key).orderBy("page_number"))).where(F.col("k") <= most)
    page = page.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("page_number")).cast("array<string>"), ",").alias("pages"))
    word = per.groupBy(*key, "word").agg(F.min(F.struct("page_number", "pos")).alias("at")).withColumn("k", F.row_number().over(W.partitionBy(*key).orderBy("at", "word"))).where(F.col("k") <= most)
    word = word.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "word"))), lambda x: x["word"]), " ").alias("contexts"))
    return total.join(page, key).join(word, key)


def ambiguous_words(pages: DataFrame) -> DataFrame:
    """Words (or parts of compounds) with å or ñ per book group and diacritic, without those that
    contain another word of the group whole.

    Contained words are met through their trigrams, not by pairing all words of a group."""
    w = pages.select("book_id", F.explode(F.regexp_extract_all("page_content", F.lit(WORD), F.lit(0))).alias("whole")).where(F.col("whole").rlike("[åñÅÑ]"))
    parts = F.filter(F.split("whole", "-"), lambda p: p.rlike("[åñÅÑ]"))
    w = w.select("book_id", F.explode(F.when(F.size(parts) > 0, parts).otherwise(F.array("whole"))).alias("word"))
    w = w.select("book_id", "word", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("word"), F.lit("[åñ]"), F.lit(0)))).alias("diacritic"))
    n = w.groupBy("diacritic", "word").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("book_id")).cast("array<string>"), ",").alias("books"))
    grams = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substr(c, i, F.lit(3)))
    long = n.where("length(word) >= 3")
    # A word of three letters or more that is contained shares its rarest trigram with its container.
    df = long.select("diacritic", "word", F.explode(F.array_distinct(grams(F.col("word")))).alias("g"))
    freq = df.groupBy("diacritic", "g").agg(F.count("*").alias("f"))
    rarest = df.join(freq, ["diacritic", "g"]).groupBy("diacritic", "word").agg(F.min(F.struct("f", "g")).alias("m")).select("diacritic", F.col("word").alias("inner"), F.col("m.g").alias("g"))
    bad = df.join(rarest, ["diacritic", "g"]).where((F.col("word") != F.col("inner")) & F.contains("word", "inner")).select("diacritic", "word").distinct()
    return n.join(bad, ["diacritic", "word"], "left_anti")


def ambiguous_words_in_order(pages: DataFrame) -> DataFrame:
    """Words (or parts of compounds) with å or ñ per diacritic, read in order: an occurrence counts
    unless another word that contains it came before (W8, without fonts, which pages don't have).

    Containment is transitive, so what counts are the occurrences before the first of any container."""
    tokens = F.regexp_extract_all("page_content", F.lit(WORD), F.lit(0))
    w = pages.select("book_id", "page_number", "content_id", F.posexplode(tokens).alias("pos", "whole")).where(F.col("whole").rlike("[åñÅÑ]"))
    w = w.select("book_id", "page_number", "content_id", "pos", F.posexplode(F.filter(F.split("whole", "-"), lambda p: p.rlike("[åñÅÑ]"))).alias("part", "word"))
    w = w.select("book_id", "word", F.struct("book_id", "page_number", "content_id", "pos", "part").alias("at"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("word"), F.lit("[åñ]"), F.lit(0)))).alias("diacritic"))
    w = materialise(w)
    first = w.groupBy("diacritic", "word").agg(F.min("at").alias("first"))
    size = F.length("word")
    grams = lambda n: F.when(size >= n, F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substr("word", i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    # A contained word is met through its rarest trigram, a shorter one through itself.
    df = first.select("diacritic", "word", "first", F.explode(F.array_distinct(F.concat(grams(1), grams(2), grams(3)))).alias("g"))
    own = df.where(F.length("g") == F.least(size, F.lit(3))).select("diacritic", "word", "g")
    freq = own.groupBy("diacritic", "g").agg(F.count("*").alias("f"))
    key = own.join(freq, ["diacritic", "g"]).groupBy("diacritic", "word").agg(F.min(F.struct("f", "g")).alias("m")).select("diacritic", F.col("word").alias("inner"), F.col("m.g").alias("g"))
    cut = df.join(key, ["diacritic", "g"]).where((F.col("word") != F.col("inner")) & F.contains("word", "inner")).groupBy("diacritic", F.col("inner").alias("word")).agg(F.min("first").alias("cut"))
    kept = w.join(cut, ["diacritic", "word"], "left").where(F.col("cut").isNull() | (F.col("at") < F.col("cut")))
    return kept.groupBy("diacritic", "word").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("book_id")).cast("array<string>"), ",").alias("books"))


def script_profile(pages: DataFrame) -> DataFrame:
    """Per book: words by script class and the profile their shares give."""
    w = pages.select("book_id", F.explode(F.split("page_content", r"\s+")).alias("w")).where("w <> ''")
    kind = F.when(F.col("w").rlike(DEVANAGARI), "dev").when(F.col("w").rlike("[āīūṛṝṣśṅñṁḥḍṭṇḷ]"), "iast").when(F.col("w").rlike("[äåçéëïöüìùòà]"), "legacy").otherwise("other")
    c = w.groupBy("book_id").agg(F.count("*").alias("words"), *[F.count_if(kind == k).alias(k) for k in ("dev", "iast", "legacy")])
    share = lambda k: F.col(k) / F.col("words")
    profile = F.when((share("dev") >= 0.05) & (F.col("dev") > F.col("iast")) & (F.col("dev") > F.col("legacy")), "devanagari").when((share("iast") >= 0.03) & (share("legacy") <= 0.01), "unicode_iast").when((share("legacy") >= 0.01) & (F.col("legacy") >= F.col("iast")), "legacy_glyph").otherwise("plain_latin")
    return c.withColumn("profile", profile)

"""Outlines, manifests and small extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def outline(resolved: DataFrame, labels: DataFrame, depth: int = 5) -> DataFrame:
    """Entries down to a depth, indented by it. resolved: of hierarchy.resolve; labels: node, label."""
    return resolved.where(F.col("depth") <= depth).join(labels, "node").select("node", "root", "depth", F.concat(F.repeat(F.lit("  "), (F.col("depth") - 1).cast("int")), F.coalesce("label", F.lit(""))).alias("line"))


def label_changes(sheet: DataFrame, page_map: DataFrame) -> DataFrame:
    """Labels of a sheet (book_id, page_number, page_label) that differ from the stored ones; a
    missing one counts as empty."""
    s = sheet.select("book_id", "page_number", F.coalesce("page_label", F.lit("")).alias("new_label"))
    return s.join(page_map.select("book_id", "page_number", F.col("page_label").alias("old_label")), ["book_id", "page_number"]).where(F.coalesce("old_label", F.lit("")) != F.col("new_label"))


def separator_counts(pages: DataFrame, key: str, text: str, first: int = 50) -> DataFrame:
    """How many of the first non-blank lines of a text have each kind of separator."""
    x = pages.select(key, F.posexplode(F.split(text, "\n")).alias("i", "x")).where(F.trim("x") != "")
    x = x.withColumn("k", F.row_number().over(W.partitionBy(key).orderBy("i"))).where(F.col("k") <= first)
    c = F.col("x")
    return x.groupBy(key).agg(F.count("*").alias("lines"), F.count_if(c.contains(" – ") | c.contains(" — ")).alias("long_dash"), F.count_if(c.contains(" - ")).alias("short_dash"), F.count_if(c.contains(": ")).alias("colon"), F.count_if((c == F.upper(c)) & c.rlike("[A-Z]")).alias("caps"))


def contexts(pages: DataFrame, key: str, text: str, char: str, around: int = 30) -> DataFrame:
    """All places of a character with what stands around it on its line."""
    return pages.select(key, F.explode(F.regexp_extract_all(text, F.lit(f"[^\\r\\n]{{0,{around}}}{char}[^\\r\\n]{{0,{around}}}"), F.lit(0))).alias("context"))


def distinct_images(images: DataFrame, inline: int = 51_200) -> DataFrame:
    """One row per book and content (its first page), inline as base64 when it is small.

    images: book_id, page_number, data."""
    h = images.withColumn("md5", F.md5("data"))
    first = h.groupBy("book_id", "md5").agg(F.min("page_number").alias("page_number"), F.count("*").alias("uses"), F.min(F.length("data")).alias("bytes"), F.any_value(F.when(F.length("data") < inline, F.base64("data"))).alias("inline"))
    return first


def section_manifest(books: DataFrame, lo, hi) -> DataFrame:
    """Pages to be copied of a book's section; none if the section leaves the book."""
    b = books.withColumn("_lo", lo).withColumn("_hi", hi).where((F.col("_lo") >= 1) & (F.col("_hi") <= F.col("number_of_pages")))
    return b.select("book_id", F.explode(F.sequence("_lo", "_hi")).alias("page_number"))


def histogram_mode(values: DataFrame, key: str, value: str, bins: int = 60) -> DataFrame:
    """Per key the first of ``bins`` equal bins with most values and its count; the last bin holds
    its upper edge."""
    r = values.groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(F.least(F.floor((F.col(value) - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins)), F.lit(bins - 1)))
    n = values.join(r, key).groupBy(key, b.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.max(F.struct("n", -F.col("bin"))).alias("m")).select(key, (-F.col("m")["col2"]).alias("bin"), F.col("m.n").alias("n"))


def embedding_texts(glossary: DataFrame, done: DataFrame) -> DataFrame:
    """'term: description' of the glossary rows that have no vector yet."""
    return glossary.join(done.select("glossary_id").distinct(), "glossary_id", "left_anti").select("glossary_id", "book_id", F.concat_ws(": ", "term", "description").alias("text"))


def devanagari_share(pages: DataFrame, top: int = 10) -> DataFrame:
    """Pages with the largest share of Devanagari words; ties by book and page."""
    w = pages.select("book_id", "page_number", F.explode(F.split("page_content", r"\s+")).alias("w")).where("w <> ''")
    g = w.groupBy("book_id", "page_number").agg(F.count("*").alias("words"), F.count_if(F.col("w").rlike("[ऀ-ॿ]")).alias("dev"))
    return g.withColumn("share", F.round(F.col("dev") / F.col("words"), 6)).orderBy(F.desc("share"), "book_id", "page_number").limit(top)

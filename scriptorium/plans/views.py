"""Canonical inputs of the library's queries over the corpus tables, in Spark and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import current, current_sql


def content(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "content", ["content_id", "book_id", "page_number", "page_content"])


def page_map(spark: SparkSession, d: str) -> DataFrame:
    """Pages that weren't deleted."""
    return current(spark, d, "page_map", ["book_id", "page_number", "page_label", "page_type", "deleted_at"]).where("deleted_at is null").drop("deleted_at")


def toc(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "table_of_contents", ["toc_id", "book_id", "toc_level", "toc_label", "page_label_raw", "page_number", "parent_toc_id"])


def glossary(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "glossary", ["glossary_id", "book_id", "term", "description"])


def glyph_words(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "dangerous_glyph_words", ["id", "book_id", "font_name", "glyph", "unicode_codepoint", "occurrence_count", "sample_words", "pages_sample"])


def word_bank(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "pbb_word_bank", ["word_id", "raw_word", "program_fixed", "ai_fixed"])


def book(spark: SparkSession, d: str) -> DataFrame:
    """One row per book of the page map."""
    b = F.col("book_id").cast("string")
    ranges = F.element_at(F.array(*[F.lit(x) for x in ("[1,4)", "[2,5]", "(1,6)", "invalid", "[10,5]")], F.lit(None)), F.col("book_id") % 6 + 1)
    return (
        page_map(spark, d)
        .groupBy("book_id")
        .agg(F.max("page_number").alias("number_of_pages"))
        .select("book_id", F.concat(F.lit("book"), b, F.lit(".pdf")).alias("pdf_name"), F.concat(F.lit("Book "), b).alias("original_book_title"), F.when(F.col("book_id") % 3 == 0, F.concat(F.lit("The Garden "), b)).alias("english_book_title"), "number_of_pages", ranges.alias("toc_pages"))
    )


def verse_index(spark: SparkSession, d: str) -> DataFrame:
    """Verse numbers printed on the pages."""
    n = F.explode(F.regexp_extract_all("page_content", F.lit(r"\|\| ([0-9]+) \|\|"), F.lit(1))).alias("n")
    return content(spark, d).select("book_id", "page_number", n).select("book_id", F.concat(F.lit("Verse "), F.col("n")).alias("verse_name"), "page_number").distinct()


BASE = f"""
WITH c_content AS MATERIALIZED (SELECT content_id, book_id, page_number, page_content FROM {current_sql("content")}),
c_map AS MATERIALIZED (SELECT book_id, page_number, page_label, page_type FROM {current_sql("page_map")} WHERE deleted_at IS NULL),
c_toc AS MATERIALIZED (SELECT toc_id, book_id, toc_level, toc_label, page_label_raw, page_number, parent_toc_id FROM {current_sql("table_of_contents")}),
c_glossary AS (SELECT glossary_id, book_id, term, description FROM {current_sql("glossary")}),
c_glyph AS (SELECT * FROM {current_sql("dangerous_glyph_words")}),
c_bank AS (SELECT * FROM {current_sql("pbb_word_bank")}),
c_book AS (SELECT book_id, concat('book', book_id, '.pdf') AS pdf_name, concat('Book ', book_id) AS original_book_title, CASE WHEN book_id % 3 = 0 THEN concat('The Garden ', book_id) END AS english_book_title, max(page_number) AS number_of_pages,
  CASE book_id % 6 WHEN 0 THEN '[1,4)' WHEN 1 THEN '[2,5]' WHEN 2 THEN '(1,6)' WHEN 3 THEN 'invalid' WHEN 4 THEN '[10,5]' END AS toc_pages FROM c_map GROUP BY book_id),
c_verse AS (SELECT DISTINCT book_id, concat('Verse ', unnest(regexp_extract_all(page_content, '\\|\\| ([0-9]+) \\|\\|', 1))) AS verse_name, page_number FROM c_content)
"""

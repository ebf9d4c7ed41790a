"""Audits of contents entries against the page map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blank(c: str):
    """NULL or only spaces."""
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def candidates(toc: DataFrame, page_map: DataFrame) -> DataFrame:
    """Contents entries with every page whose trimmed label is theirs; labels that repeat fan out."""
    t = toc.withColumn("_label", F.trim("page_label_raw"))
    p = page_map.select(F.col("book_id").alias("_b"), F.trim("page_label").alias("_l"), F.col("page_number").alias("map_page"))
    return t.join(p, (F.col("book_id") == F.col("_b")) & (F.col("_label") == F.col("_l"))).drop("_b", "_l", "_label")


def unmatched(toc: DataFrame, page_map: DataFrame) -> DataFrame:
    """Entries with a label that no page has."""
    t = toc.where(~blank("page_label_raw")).withColumn("_label", F.trim("page_label_raw"))
    p = page_map.select(F.col("book_id").alias("_b"), F.trim("page_label").alias("_l"))
    return t.join(p, (F.col("book_id") == F.col("_b")) & (F.col("_label") == F.col("_l")), "left_anti").drop("_label")


def match_rate(toc: DataFrame, page_map: DataFrame) -> DataFrame:
    t = toc.where(~blank("page_label_raw")).withColumn("_label", F.trim("page_label_raw"))
    p = page_map.select(F.col("book_id").alias("_b"), F.trim("page_label").alias("_l"), F.col("page_number").alias("map_page"))
    j = t.join(p, (F.col("book_id") == F.col("_b")) & (F.col("_label") == F.col("_l")), "left")
    return j.groupBy("book_id").agg(F.count("toc_id").alias("entries"), F.count("map_page").alias("matched"), (F.count("toc_id") - F.count("map_page")).alias("unmatched"))


def mismatches(toc: DataFrame, page_map: DataFrame) -> DataFrame:
    """Entries whose page number isn't that of their label; entries without a number drop out."""
    return candidates(toc, page_map).where("page_number <> map_page").select("toc_id", "book_id", "page_number", "map_page")


def already_correct(toc: DataFrame, page_map: DataFrame) -> DataFrame:
    return candidates(toc, page_map).where("page_number = map_page").select("toc_id", "book_id", "page_number")


def updates(toc: DataFrame, page_map: DataFrame) -> DataFrame:
    """Page numbers to be written: those that differ, a missing number included."""
    return candidates(toc, page_map).where("not (page_number <=> map_page)").select("toc_id", "book_id", F.col("page_number").alias("old_page"), F.col("map_page").alias("new_page"))


def blank_labels(toc: DataFrame) -> DataFrame:
    return toc.where(blank("page_label_raw")).groupBy("book_id").agg(F.count("*").alias("blank"))


def unusual_labels(toc: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent labels that are neither digits nor lower-case Roman numerals, with the books
    that have them; ties by label."""
    odd = toc.where(~blank("page_label_raw") & ~F.col("page_label_raw").rlike("^[0-9]+$") & ~F.col("page_label_raw").rlike("^[ivxlcdm]+$"))
    return odd.groupBy("page_label_raw").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(F.col("book_id").cast("string"))), ", ").alias("books")).orderBy(F.desc("n"), "page_label_raw").limit(top)


def special_labels(toc: DataFrame) -> DataFrame:
    """Labels with other signs, longer than ten or with white space."""
    c = F.col("page_label_raw")
    return toc.where(~blank("page_label_raw") & (c.rlike(r"[^a-zA-Z0-9ivxlcdm\-.]") | (F.length(c) > 10) | c.rlike(r"\s"))).select("toc_id", "book_id", "page_label_raw")


def toc_stats(toc: DataFrame) -> DataFrame:
    return toc.agg(F.count("*").alias("total"), F.count("page_number").alias("with_page"), (F.count("*") - F.count("page_number")).alias("without_page"), F.count_if(blank("page_label_raw")).alias("blank_label"))


def page_map_stats(page_map: DataFrame) -> DataFrame:
    return page_map.agg(F.count("*").alias("total"), F.count_distinct("page_label").alias("labels"), F.count_if(blank("page_label")).alias("blank_label"))


def only_type(page_map: DataFrame, kind: str = "Primary") -> DataFrame:
    """Books all of whose typed pages have one type; pages without a type don't count."""
    return page_map.groupBy("book_id").agg(F.count_distinct("page_type").alias("_n"), F.max("page_type").alias("_t")).where((F.col("_n") == 1) & (F.col("_t") == kind)).select("book_id")


def label_diagnosis(stored: DataFrame, extracted: DataFrame) -> DataFrame:
    """Full outer comparison of two label maps (book_id, page_number, page_label)."""
    s = stored.select("book_id", "page_number", F.coalesce(F.trim("page_label"), F.lit("")).alias("stored_label"), F.lit(1).alias("_s"))
    e = extracted.select("book_id", "page_number", F.coalesce(F.trim("page_label"), F.lit("")).alias("pdf_label"), F.lit(1).alias("_e"))
    issue = F.when(F.col("_s").isNull(), "MISSING_IN_DB").when(F.col("_e").isNull(), "MISSING_IN_PDF").when(F.col("stored_label") != F.col("pdf_label"), "MISMATCH")
    return s.join(e, ["book_id", "page_number"], "full_outer").select("book_id", "page_number", "stored_label", "pdf_label", issue.alias("issue")).where("issue is not null")

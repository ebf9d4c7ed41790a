"""Types of pages from position, content and images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import range_bounds
from ..functions.text import confidence, empty_page, publisher_score


def classify(content: DataFrame, core: DataFrame, ranges: DataFrame | None = None, images: DataFrame | None = None) -> DataFrame:
    """page_type, confidence, score and original_type of every page.

    core: book_id, core_start, core_end; without both, all pages are Core with low confidence.
    ranges: book_id, toc_pages, glossary_pages, verse_pages as range texts; later ones win.
    images: book_id, page_number, coverage (total), largest, images. Then, in this order, a page is
    Empty, Publisher Info (outside the ranges) or Image Page (Core only)."""
    # Of the texts only the score and whether they are empty go through the joins.
    t = content.select("book_id", "page_number", F.coalesce(publisher_score(F.col("page_content")), F.lit(0)).alias("_pub"), empty_page(F.col("page_content")).alias("_empty")).join(core, "book_id", "left")
    kinds = [("toc_pages", "Table of Contents"), ("glossary_pages", "Glossary"), ("verse_pages", "Verse Index")]
    ranges = ranges if ranges is not None else content.select("book_id").distinct().select("book_id", *[F.lit(None).cast("string").alias(c) for c, _ in kinds])
    t = t.join(ranges.select("book_id", *[F.col(c) if c in ranges.columns else F.lit(None).cast("string").alias(c) for c, _ in kinds]), "book_id", "left")
    p = F.col("page_number")
    both = F.col("core_start").isNotNull() & F.col("core_end").isNotNull()
    base = F.when(~both, "Core").when(p < F.col("core_start"), "Prefix").when(p <= F.col("core_end"), "Core").otherwise("Postfix")
    ranged = base
    in_range = F.lit(False)
    for c, name in kinds:
        lo, hi = range_bounds(F.col(c))
        hit = F.coalesce((p >= lo) & (p <= hi), F.lit(False))
        ranged, in_range = F.when(hit, name).otherwise(ranged), in_range | hit
    t = t.withColumn("_type", ranged).withColumn("_in", in_range).withColumn("_base", F.when(both, 6.0).otherwise(3.0)).withColumn("_level", F.when(both, "medium").otherwise("low"))
    if images is not None:
        t = t.join(images.select("book_id", "page_number", "coverage", "largest", "images"), ["book_id", "page_number"], "left")
        image = image_page(F.col("coverage"), F.col("largest"), F.col("images"))
    else:
        image = F.lit(None).cast("string")
    t = t.withColumn("_image", F.when(F.col("_type") == "Core", image))
    pub = (F.col("_pub") >= 6) & ~F.col("_in")
    return t.select(
        "book_id", "page_number",
        F.when(F.col("_empty"), "Empty").when(pub, "Publisher Info").when(F.col("_image").isNotNull(), "Image Page").otherwise(F.col("_type")).alias("page_type"),
        F.when(F.col("_empty"), "high").when(pub, confidence(F.col("_pub"))).when(F.col("_image").isNotNull(), F.col("_image")).when(F.col("_in"), "high").otherwise(F.col("_level")).alias("confidence"),
        F.when(F.col("_empty"), 9.0).when(pub, F.col("_pub").cast("double")).when(F.col("_image").isNotNull(), 8.0).when(F.col("_in"), 10.0).otherwise(F.col("_base")).alias("score"),
        F.col("_type").alias("original_type"),
    )


def image_page(total, largest, count):
    """Confidence that a page is an image, NULL if it isn't."""
    return F.when((largest >= 0.9) & (count <= 2), "high").when(total >= 0.9, "high").when(total >= 0.75, "medium")


def changes(classified: DataFrame, page_map: DataFrame, books: DataFrame, old: str = "Primary") -> DataFrame:
    """New types of pages that had the old type, in the books named."""
    m = page_map.join(books.select("book_id"), "book_id", "left_semi").where(F.col("page_type") == old).select("book_id", "page_number")
    return classified.join(m, ["book_id", "page_number"], "left_semi").where(F.col("page_type") != old).select("book_id", "page_number", "page_type")


def breakdown(classified: DataFrame) -> DataFrame:
    return classified.groupBy("page_type").agg(F.count("*").alias("n"))

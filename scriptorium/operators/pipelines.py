"""Sequences of operators that make up the library's jobs. Each is a lazy plan or a list of named
changes, so a dry run is the same plan without the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels, text, transliteration
from . import contents, layout, pages, parsers, quality, store


def section_texts(content: DataFrame, books: DataFrame, ranges: str) -> DataFrame:
    """Text of the pages of a book's section, joined by blank lines in page order: book_id, text.

    ranges: the column of books with the section's range as text. Pages without text are left out, and
    so are books without a range. A section is parsed whole, so its pages meet in one row."""
    lo, hi = labels.range_bounds(F.col(ranges))
    b = books.select(F.col("book_id").alias("_b"), lo.alias("_lo"), hi.alias("_hi")).where("_lo is not null")
    p = content.join(b, F.expr("book_id = _b and page_number between _lo and _hi")).where(F.trim("page_content") != "")
    return p.groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "page_content"))), lambda x: x["page_content"]), "\n\n").alias("text"))


def book_glossaries(content: DataFrame, books: DataFrame, ranges: str = "glossary_pages") -> DataFrame:
    """Entries of the glossary section of every book: book_id, term, description, entry_order."""
    return parsers.glossaries(section_texts(content, books, ranges).select(F.col("book_id").cast("long").alias("id"), "text")).withColumnRenamed("id", "book_id")


def book_verses(content: DataFrame, books: DataFrame, ranges: str = "verse_pages") -> DataFrame:
    """Entries of the verse index of every book: glyphs mapped, leaders in one form, then parsed."""
    t = section_texts(content, books, ranges).select(F.col("book_id").cast("long").alias("id"), text.verse_lines(transliteration.map_glyphs(F.col("text"))).alias("text"))
    return parsers.verses(t).withColumnRenamed("id", "book_id")


def transliterate_pages(spans: DataFrame, done: DataFrame, worklist: DataFrame, resume: bool = True) -> tuple[DataFrame, DataFrame]:
    """Pages of a worklist (book_id, page_number) read from spans without Devanagari fonts, repaired and
    merged into the pages there are: the changes and the table after them.

    spans: page_id, book_id, page_number and what layout.region needs. With ``resume`` pages that have
    a text already are passed over; a page that can't be read keeps its old text."""
    todo = worklist.select("book_id", "page_number").distinct()
    if resume:
        todo = todo.join(done.where("page_content <> ''").select("book_id", "page_number"), ["book_id", "page_number"], "left_anti")
    s = layout.without_fonts(spans.join(todo, ["book_id", "page_number"], "left_semi"))
    ids = s.select("page_id", "book_id", "page_number").distinct()
    read = layout.region(s, "body", F.lit(0.0), F.lit(None).cast("double")).join(ids, "page_id")
    new = read.select("book_id", "page_number", transliteration.fix_text(F.col("text")).alias("page_content"))
    return new, store.upsert(done, new, ["book_id", "page_number"])


def core_content(spans: DataFrame, page_map: DataFrame, header: Column, footer: Column) -> DataFrame:
    """Body text of the pages of type Core, glyphs mapped: rows to be inserted. A page without spans
    has no row."""
    core = pages_of(page_map, "Core")
    s = spans.join(core, ["book_id", "page_number"], "left_semi")
    ids = s.select("page_id", "book_id", "page_number").distinct()
    return layout.region(s, "body", header, footer).join(ids, "page_id").select("book_id", "page_number", transliteration.map_glyphs(F.col("text")).alias("page_content"))


def pages_of(page_map: DataFrame, kind: str) -> DataFrame:
    return page_map.where(F.col("page_type") == kind).select("book_id", "page_number")


def html_books(lines: DataFrame, written: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """One HTML document per page of every book: book_id, page_number, html. Books that were written
    already (book_id) are passed over unless they are to be overwritten.

    lines: book_id, page_number, line_no, text, size, flags, font, image (data URI or NULL)."""
    if written is not None and not overwrite:
        lines = lines.join(written.select("book_id").distinct(), "book_id", "left_anti")
    t = parsers.styled(F.col("text"), F.col("flags"), F.col("font"))
    tag = F.when(F.col("size") > 14, "h1").when(F.col("size") > 12, "h2").otherwise("p")
    block = F.when(F.col("image").isNotNull(), F.concat(F.lit('<img src="'), "image", F.lit('"/>'))).otherwise(F.concat(F.lit("<"), tag, F.lit(">"), t, F.lit("</"), tag, F.lit(">")))
    # As many lines as the page has.
    body = lines.groupBy("book_id", "page_number").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", block.alias("b")))), lambda x: x["b"]), "\n").alias("body"))
    head = F.concat(F.lit('<html><head><meta charset="utf-8"/><meta name="book" content="'), F.col("book_id").cast("string"), F.lit('"/><meta name="page" content="'), F.col("page_number").cast("string"), F.lit('"/></head><body>\n'))
    return body.select("book_id", "page_number", F.concat(head, "body", F.lit("\n</body></html>")).alias("html"))


def import_first(files: DataFrame, books: DataFrame, labels_: DataFrame, bookmarks: DataFrame) -> dict[str, DataFrame]:
    """First half of an import: the tables as they are after it.

    files: pdf_name, number_of_pages of what was scanned. labels: pdf_name, page_number, page_label.
    bookmarks: pdf_name, toc_level, toc_label, page_number, place. Files whose name is known make no
    new book. ``sheet`` holds the rows for review, ``render`` the pages to be rendered."""
    fresh = files.join(books.select("pdf_name"), "pdf_name", "left_anti").dropDuplicates(["pdf_name"])
    made = store.with_ids(books, fresh, "book_id", ["pdf_name"])
    ids = made.select("pdf_name", F.col("book_id").alias("_id"))
    mapped = labels_.join(ids, "pdf_name").select(F.col("_id").alias("book_id"), "page_number", labels.next_label(F.col("page_label"), F.col("page_number")).alias("page_label"), F.lit("Primary").alias("page_type"))
    marks = bookmarks.join(ids, "pdf_name").select(F.col("_id").alias("book_id"), "toc_level", F.trim("toc_label").alias("toc_label"), "page_number", "place")
    return {"book": made, "page_map": mapped, "bookmarks": marks, "sheet": made.select("book_id", "pdf_name", "number_of_pages"), "render": made.select("book_id", "pdf_name", F.explode(F.sequence(F.lit(1), F.col("number_of_pages"))).alias("page_number"))}


def import_second(books: DataFrame, page_map: DataFrame, toc: DataFrame, sheets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Second half of an import, from the reviewed sheets: the tables as they are after it.

    sheets: ``books`` (book_id and columns to be set; placeholders are left out), ``pages`` (book_id,
    page_number, page_label), ``toc`` (book_id, place, toc_level, toc_label, page_label_raw; it replaces
    the contents of its books, in order, with parents by level). A sheet that is missing changes nothing."""
    out = {"book": books, "page_map": page_map, "toc": toc}
    if "books" in sheets:
        out["book"] = store.upsert(books, sheets["books"].where("book_id is not null"), ["book_id"])
    if "pages" in sheets:
        out["page_map"] = store.upsert(page_map, sheets["pages"].select("book_id", "page_number", F.nullif(F.trim("page_label"), F.lit("")).alias("page_label")), ["book_id", "page_number"])
    if "toc" in sheets:
        rows = store.with_ids(toc, sheets["toc"], "toc_id", ["book_id", "place"])
        rows = rows.select("toc_id", "book_id", "toc_level", "toc_label", "page_label_raw")
        parents = contents.parents_by_level(rows).select("toc_id", "parent_toc_id")
        out["toc"] = store.replace_groups(toc, rows.join(parents, "toc_id").select(*[c if c in (*rows.columns, "parent_toc_id") else F.lit(None).alias(c) for c in toc.columns]), ["book_id"])
    return out


def reclassify(content: DataFrame, core: DataFrame, books: DataFrame, page_map: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """New types of the pages of books that have only the type of the load (Primary)."""
    only = quality.only_type(page_map)
    c = content.join(only, "book_id", "left_semi")
    return pages.changes(pages.classify(c, core, books, images), page_map, only)

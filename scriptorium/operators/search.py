"""Listing, point lookup and substring search over books and pages."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def like_any(term: str, columns: list[str]) -> Column:
    """Case-insensitive substring match in any column; % and _ in the term are wildcards."""
    return reduce(or_, [F.col(c).ilike(f"%{term}%") for c in columns])


def books_by_name(book: DataFrame, pdf_name: str) -> DataFrame:
    return book.where(F.col("pdf_name") == pdf_name).select("book_id")


#: Columns of a book's row.
BOOK = ["book_id", "pdf_name", "original_book_title", "english_book_title", "edition", "number_of_pages", "file_size_bytes", "original_author", "commentary_author", "header_height", "footer_height", "page_label_location", "toc_pages", "verse_pages", "glossary_pages", "created_at", "updated_at"]


def book_by_id(book: DataFrame, book_id: int) -> DataFrame:
    """The whole row of one book; columns the table hasn't are NULL."""
    return book.where(F.col("book_id") == book_id).select(*[F.col(c) if c in book.columns else F.lit(None).cast("string").alias(c) for c in BOOK])


def by_name_or_stem(files: DataFrame, book: DataFrame) -> DataFrame:
    """files: pdf_name. Adds book_id by the whole name, else by the name without its extension
    (ignoring case); of several books the one of lowest id. NULL: neither is known."""
    stem = lambda c: F.lower(F.regexp_replace(c, r"\.[^.]*$", ""))
    whole = book.where("pdf_name is not null").groupBy(F.col("pdf_name").alias("_n")).agg(F.min("book_id").alias("_a"))
    part = book.where("pdf_name is not null").groupBy(stem(F.col("pdf_name")).alias("_s")).agg(F.min("book_id").alias("_b"))
    return files.join(whole, F.col("pdf_name") == F.col("_n"), "left").join(part, stem(F.col("pdf_name")) == F.col("_s"), "left").withColumn("book_id", F.coalesce("_a", "_b")).drop("_n", "_a", "_s", "_b")


def without_placeholders(rows: DataFrame, title: str, mark: str = "[TO BE ADDED]") -> DataFrame:
    """Rows whose title isn't a placeholder; a NULL title is none."""
    return rows.where(~F.coalesce(F.col(title).startswith(mark), F.lit(False)))


def chosen(rows: DataFrame, **wanted: object) -> DataFrame:
    """Rows that fit all filters given: a list is a choice of values, anything else one value; None
    or an empty list is no filter."""
    for column, value in wanted.items():
        if isinstance(value, (list, tuple, set)):
            rows = rows.where(F.col(column).isin(list(value))) if value else rows
        elif value is not None:
            rows = rows.where(F.col(column) == value)
    return rows


def pages_of_type(page_map: DataFrame, kind: str) -> DataFrame:
    """Pages of one type in order."""
    return page_map.where(F.col("page_type") == kind).orderBy("book_id", "page_number")


def search_books(book: DataFrame, term: str, columns: list[str] | None = None) -> DataFrame:
    return book.where(like_any(term, columns or ["original_book_title", "english_book_title", "pdf_name"])).orderBy("original_book_title")


def list_books(book: DataFrame, limit: int | None = None) -> DataFrame:
    """All books by title; no or a zero limit lists all."""
    out = book.orderBy("original_book_title", "book_id")
    return out.limit(limit) if limit else out


def page_text(content: DataFrame, book_id: int, page: int) -> DataFrame:
    return content.where((F.col("book_id") == book_id) & (F.col("page_number") == page)).select("page_content")


def search_content(content: DataFrame, book: DataFrame, page_map: DataFrame, term: str, books: list[int] | None = None) -> DataFrame:
    """Pages whose text contains the term, with title and label where the page is mapped."""
    c = content.where(F.col("page_content").ilike(f"%{term}%"))
    if books:
        c = c.where(F.col("book_id").isin(books))
    # The text itself goes through no join.
    c = c.select("book_id", "page_number", F.length("page_content").alias("chars"))
    named = book.select("book_id", F.coalesce("english_book_title", "original_book_title").alias("title"))
    return c.join(named, "book_id").join(page_map.select("book_id", "page_number", "page_label"), ["book_id", "page_number"], "left").select("book_id", "title", "page_number", "page_label", "chars")


def verse_locations(verses: DataFrame, book: DataFrame, term: str) -> DataFrame:
    return verses.where(F.col("verse_name").ilike(f"%{term}%")).join(book.select("book_id", "pdf_name"), "book_id").select("book_id", "pdf_name", "verse_name", "page_number")


def render_tasks(page_map: DataFrame, book: DataFrame, books: list[int] | None = None, restart: int | None = None) -> DataFrame:
    """Pages to render, optionally of some books or from one book on."""
    p = page_map
    if books:
        p = p.where(F.col("book_id").isin(books))
    if restart is not None:
        p = p.where(F.col("book_id") >= restart)
    return p.join(book.select("book_id", "pdf_name"), "book_id").select("book_id", "pdf_name", "page_number", "page_label")


def render_audit(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected and actual pages per book and whether the book is complete, partial or missing."""
    e = expected.groupBy("book_id").agg(F.count("*").alias("expected"))
    a = actual.groupBy("book_id").agg(F.count("*").alias("actual"))
    n = F.coalesce("actual", F.lit(0).cast("long"))
    state = F.when(n == 0, "missing").when(n < F.col("expected"), "partial").otherwise("complete")
    return e.join(a, "book_id", "left").select("book_id", "expected", n.alias("actual"), state.alias("state"))


def character_contexts(content: DataFrame, char: str, around: int = 20) -> DataFrame:
    """Text around the first place where a page has the character."""
    at = F.locate(char, F.col("page_content"))
    start = F.greatest(at - around, F.lit(1))
    return content.where(F.col("page_content").contains(char)).select("book_id", "page_number", F.substr("page_content", start, at - start + around).alias("context"))


def word_page_counts(content: DataFrame, words: list[str]) -> DataFrame:
    """For each word the number of pages that contain it, in one pass."""
    one = content.agg(*[F.count_if(F.col("page_content").ilike(f"%{w}%")).alias(f"w{i}") for i, w in enumerate(words)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(w).alias("word"), F.col(f"w{i}").alias("pages")) for i, w in enumerate(words)])))


def cleaning_work(content: DataFrame, restart: int = 1) -> DataFrame:
    """Pages with text that have no cleaned text (ai_page_content) yet, from a page on."""
    return content.where((F.coalesce(F.col("page_content"), F.lit("")) != "") & (F.coalesce(F.col("ai_page_content"), F.lit("")) == "") & (F.col("page_number") >= restart))


def resume_points(content: DataFrame, page_map: DataFrame) -> DataFrame:
    """Last page with text and number of mapped pages still without any, per book."""
    done = content.where("page_content is not null and page_content <> ''").select("book_id", "page_number")
    last = done.groupBy("book_id").agg(F.max("page_number").alias("last_page"))
    open_ = page_map.select("book_id", "page_number").join(done, ["book_id", "page_number"], "left_anti").groupBy("book_id").agg(F.count("*").alias("missing"))
    return page_map.select("book_id").distinct().join(last, "book_id", "left").join(open_, "book_id", "left").select("book_id", "last_page", F.coalesce("missing", F.lit(0).cast("long")).alias("missing"))


def page_worklist(book: DataFrame, start: int = 1) -> DataFrame:
    """All pages of every book from one on, whether they were done or not."""
    return book.where(F.col("number_of_pages") >= start).select("book_id", F.explode(F.sequence(F.lit(start), F.col("number_of_pages"))).alias("page_number"))


def valid_pages(wanted: DataFrame, book: DataFrame) -> DataFrame:
    """Wanted pages (book_id, page_number) that their book has."""
    return wanted.select("book_id", "page_number").distinct().join(book.select("book_id", "number_of_pages"), "book_id").where("page_number between 1 and number_of_pages").select("book_id", "page_number")


def numbers_to_labels(wanted: DataFrame, page_map: DataFrame) -> DataFrame:
    """Label of every wanted page (book_id, page_number), NULL where it isn't mapped."""
    return wanted.select("book_id", "page_number").join(page_map.select("book_id", "page_number", "page_label"), ["book_id", "page_number"], "left")

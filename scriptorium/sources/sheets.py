"""Sheets as CSV text: a first line that is no header, headers that are nearly right, appended tabs."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_summary


def header_of(spark: SparkSession, path: str, *parts: str) -> tuple[list[str], int]:
    """Column names of a CSV and how many lines to pass over: the first is none if it hasn't all parts."""
    first = [r.value for r in spark.read.text(path).limit(2).collect()]
    skip = 0 if first and all(p in first[0].lower() for p in parts) else 1
    names = next(csv.reader([first[skip]])) if len(first) > skip else []
    return [n.strip() for n in names], skip


def column_like(names: list[str], *parts: str) -> str | None:
    """The last column whose name has all parts in it, ignoring case."""
    hits = [n for n in names if all(p in n.lower() for p in parts)]
    return hits[-1] if hits else None


def read_sheet(spark: SparkSession, path: str, *parts: str) -> tuple[DataFrame, list[str]]:
    """The rows of a CSV as text columns; a first line without the parts of a header is passed over."""
    names, _ = header_of(spark, path, *parts)
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = spark.read.option("multiLine", True).csv(path, schema=schema, header=False)
    # The header, and the line before it, are rows of this read.
    head = names[0]
    return rows.where(F.coalesce(F.trim(F.col(f"`{head}`")) != head, F.lit(True)) & ~_is_title(rows, names)), names


def _is_title(rows: DataFrame, names: list[str]) -> Column:
    """A line that fills only the first of several columns with something that is no number."""
    if len(names) < 2:
        return F.lit(False)
    rest = F.coalesce(*[F.col(f"`{n}`") for n in names[1:]])
    return rest.isNull() & ~F.coalesce(F.col(f"`{names[0]}`").rlike(r"^\s*[0-9]*\s*$"), F.lit(True))


def updates(rows: DataFrame, id_: str, value: str, clean: Column) -> DataFrame:
    """book_id, value, outcome of every row: ``skipped`` without an id or a value, ``error`` for an id
    that is no number, else ``update``."""
    i = F.trim(F.coalesce(F.col(f"`{id_}`"), F.lit("")))
    n = i.try_cast("int")
    outcome = F.when(i == "", "skipped").when(n.isNull(), "error").when(clean == "", "skipped").otherwise("update")
    return rows.select(n.alias("book_id"), clean.alias("value"), outcome.alias("outcome"))


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """Summaries of a CSV with the columns 'Book Id' and 'Book Summary', cleaned."""
    rows, names = read_sheet(spark, path, "book", "id")
    if "Book Id" not in names or "Book Summary" not in names:
        raise ValueError(f"columns 'Book Id' and 'Book Summary' are needed, found {names}")
    return updates(rows, "Book Id", "Book Summary", clean_summary(F.col("`Book Summary`")))


def titles(spark: SparkSession, path: str) -> DataFrame:
    """Titles of a CSV whose columns are named like a book's id and title."""
    rows, names = read_sheet(spark, path, "book", "id")
    id_, title = column_like(names, "book", "id"), column_like(names, "book", "title")
    if not id_ or not title:
        raise ValueError(f"columns for a book's id and title are needed, found {names}")
    return updates(rows, id_, title, F.trim(F.coalesce(F.col(f"`{title}`"), F.lit(""))))


def append_tab(df: DataFrame, folder: str, tab: str) -> None:
    """Rows after those of a tab; the tab is opened or made, and repeated rows stay."""
    df.write.mode("append").option("header", True).csv(f"{folder}/{tab}")


def read_tab(spark: SparkSession, folder: str, tab: str) -> DataFrame:
    """All rows of a tab as text, missing cells as ''."""
    return spark.read.csv(f"{folder}/{tab}", header=True, inferSchema=False).na.fill("")


def round_trip(spark: SparkSession, folder: str) -> bool:
    """Whether rows written to a tab come back: a probe of the store."""
    df = spark.createDataFrame([("1", "a")], "id string, name string")
    append_tab(df, folder, "probe")
    return read_tab(spark, folder, "probe").where("id = '1' and name = 'a'").count() > 0

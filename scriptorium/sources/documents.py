"""Files that need a library of their own to be read or written, through parsers that are handed in.

A parser takes a file's bytes and yields dicts; it runs where the file is read, a file at a time. What
it can't read is kept as a row with its error. No parser of a format is required by this package.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import clean_value

Parser = Callable[[bytes], Iterable[dict]]


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, length, modificationTime, content of the files under a folder."""
    return spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup="true").load(folder)


def parsed(found: DataFrame, parser: Parser, schema: StructType) -> DataFrame:
    """found: of ``files``. path, status (success or error), error and the parser's fields; a file that
    can't be read is one row with NULL in them, one in which nothing is found has no row."""
    names = [f.name for f in schema.fields]
    full = StructType().add("path", "string").add("status", "string").add("error", "string")
    for f in schema.fields:
        full = full.add(f)

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(path, "success", None, *[r.get(n) for n in names]) for r in parser(bytes(content))]
                except Exception as e:  # noqa: BLE001 - any failure of a file is a row of the result
                    rows.append((path, "error", str(e)[:500], *[None] * len(names)))
            if rows:
                yield pd.DataFrame(rows, columns=["path", "status", "error", *names])

    return found.select("path", "content").mapInPandas(run, full)


def metadata(found: DataFrame, parser: Parser, fields: list[str]) -> DataFrame:
    """File facts and document information of every file, error rows included; blank values are NULL."""
    kind = StructType()
    for f in fields:
        kind = kind.add(f, "string")
    info = parsed(found, parser, kind)
    facts = found.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "modificationTime")
    return facts.join(info, "path", "left").select("path", "file_name", "length", "modificationTime", F.coalesce("status", F.lit("success")).alias("status"), "error", *[clean_value(F.col(f)).alias(f) for f in fields])


_INFO = re.compile(rb"/(Title|Author|Subject|Creator|Producer|CreationDate|ModDate)\s*\(((?:[^()\\]|\\.)*)\)")


def pdf_info(content: bytes) -> list[dict]:
    """Document information that stands uncompressed in a PDF, as one dict."""
    if not content.startswith(b"%PDF"):
        raise ValueError("not a PDF")
    return [{m[1].decode(): re.sub(rb"\\(.)", rb"\1", m[2]).decode("latin-1") for m in _INFO.finditer(content)}]


def summary(info: DataFrame) -> DataFrame:
    """One JSON document: counts of the extraction and the rows it is about are written beside it."""
    good = F.count_if(F.col("status") == "success")
    return info.agg(F.count("*").alias("total_files_processed"), good.alias("successful_extractions"), (F.count("*") - good).alias("failed_extractions"))


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def sheet_rows(content: bytes, sheet: int = 1, required: str | None = None) -> list[dict]:
    """Rows of a sheet of a workbook as dicts of text by its header; blank rows, and those without the
    required column, are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = []
        if "xl/sharedStrings.xml" in z.namelist():
            strings = ["".join(t.text or "" for t in s.iterfind(".//m:t", _NS)) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
        table = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    out, header = [], None
    for row in table.iterfind(".//m:row", _NS):
        cells: dict[int, str] = {}
        for i, c in enumerate(row.iterfind("m:c", _NS)):
            v = c.find("m:v", _NS)
            if c.get("t") == "inlineStr":
                value = "".join(t.text or "" for t in c.iterfind(".//m:t", _NS))
            else:
                value = (strings[int(v.text)] if c.get("t") == "s" else v.text or "") if v is not None else ""
            cells[_column(c.get("r")) if c.get("r") else i] = value.strip()
        if header is None:
            header = {i: v for i, v in cells.items() if v}
        elif any(cells.values()):
            r = {name: cells.get(i) or None for i, name in header.items()}
            if required is None or r.get(required):
                out.append(r)
    return out


def rendered(tasks: DataFrame, renderer: Callable[[str, int], bytes], existing: DataFrame | None = None) -> DataFrame:
    """tasks: pdf_name, page_number, target. target, status, data of the pages rendered; targets that
    exist (path) are passed over, and a page that fails is an error row."""
    if existing is not None:
        tasks = tasks.join(existing.select(F.col("path").alias("target")), "target", "left_anti")

    def run(batches):
        for pdf in batches:
            rows = []
            for name, page, target in zip(pdf["pdf_name"], pdf["page_number"], pdf["target"]):
                try:
                    rows.append((target, "success", renderer(name, int(page))))
                except Exception as e:  # noqa: BLE001 - any failure of a page is a row of the result
                    rows.append((target, f"error: {e}"[:500], None))
            yield pd.DataFrame(rows, columns=["target", "status", "data"])

    return tasks.select("pdf_name", "page_number", "target").mapInPandas(run, "target string, status string, data binary")


def called(rows: DataFrame, key: str, column: str, service: Callable[[list[str]], list], kind: str) -> DataFrame:
    """key and result of a service that takes texts in batches (embedding, cleaning): NULL where the
    text is NULL, where the service has no answer and where it fails."""

    def run(batches):
        for pdf in batches:
            texts = [t for t in pdf[column] if t is not None]
            try:
                got = iter(service(texts) if texts else [])
                result = [None if t is None else next(got, None) for t in pdf[column]]
            except Exception:  # noqa: BLE001 - a failed call gives no result
                result = [None] * len(pdf)
            yield pd.DataFrame({key: pdf[key], "result": pd.Series(result, dtype=object)})

    source = dict(rows.dtypes)[key]
    return rows.select(key, column).mapInPandas(run, f"{key} {source}, result {kind}")

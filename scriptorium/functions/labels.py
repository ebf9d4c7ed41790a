"""Page ranges and page labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_bounds(text: Column) -> tuple[Column, Column]:
    """Inclusive bounds of '[a,b)' or '[a,b]'; an opening bracket of either kind includes a. NULL
    for anything else, for a < 1 and for an end before the start."""
    m = r"^\s*[\[(]\s*([0-9]+)\s*,\s*([0-9]+)\s*([\])])\s*$"
    lo = F.regexp_extract(text, m, 1).try_cast("int")
    hi = F.regexp_extract(text, m, 2).try_cast("int") - F.when(F.regexp_extract(text, m, 3) == ")", 1).otherwise(0)
    ok = (lo > 0) & (hi >= lo)
    return F.when(ok, lo), F.when(ok, hi)


def format_range(text: Column) -> Column:
    """'3-7' or '3,7' as '[3,8)'; a bracketed range or anything else stays."""
    m = r"^\s*([0-9]+)\s*[-,]\s*([0-9]+)\s*$"
    return F.when(text.rlike(m), F.concat(F.lit("["), F.regexp_extract(text, m, 1), F.lit(","), (F.regexp_extract(text, m, 2).try_cast("int") + 1).cast("string"), F.lit(")"))).otherwise(text)


def valid_label(label: Column) -> Column:
    """Up to ten digits, fifteen Roman numerals or ten letters and digits, beside - . and _."""
    x = F.regexp_replace(label, r"[\-._]", "")
    return x.rlike(r"^[0-9]{1,10}$") | x.rlike(r"(?i)^[ivxlcdm]{1,15}$") | x.rlike(r"^[0-9A-Za-z]{1,10}$")


# Shapes of page labels in footers, in order of trial.
_L, _R = r"(?:^|[^\p{L}\p{M}\p{N}_])", r"(?:[^\p{L}\p{M}\p{N}_]|$)"
SHAPES = [_L + r"([0-9]+(?:\s+[0-9]+)+)" + _R, _L + r"([ivxlcdm]+(?:\s+[ivxlcdm]+)+)" + _R, r"\(([0-9]+)\)", r"\(([ivxlcdm]+)\)", _L + r"([0-9]+)" + _R, _L + r"([ivxlcdm]+)" + _R]


def label_of(text: Column) -> Column:
    """The page label in a footer's text: the first shape whose first match is valid, else ''."""
    found = [F.replace(F.regexp_extract(text, "(?i)" + s, 1), F.lit(" "), F.lit("")) for s in SHAPES]
    return F.coalesce(*[F.when((x != "") & (F.length(x) <= 20) & valid_label(x), x) for x in found], F.lit(""))


def next_label(label: Column, page: Column) -> Column:
    """The label, or the page number where there is none."""
    return F.coalesce(F.nullif(F.trim(label), F.lit("")), page.cast("string"))

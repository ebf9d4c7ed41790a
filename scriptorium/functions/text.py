"""Statistics, scores and error patterns of texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Signs of a publisher's page (3 points each) and of other front matter (-2).
PUBLISHER = [
    r"©|copyright|creative commons|some rights reserved",
    r"ISBN|ISSN|Library of Congress Control Number|British Library Cataloguing",
    r"Cataloging in Publication Data|CIP|D\.K\. Agencies",
    r"(First|Second|Third|Fourth) Edition|Printed at|Printed by|edition|reprint",
    r"Worldwide Cent(er|re)s & Contacts|our websites|contact us",
    r"books by|english titles published by|titles published by",
    r"Permissions beyond the scope of this license|Attribution-No Derivative Works|creativecommons\.org",
]
OTHER = r"\b(Contents|Table of Contents|Chapter|Preface|Introduction)\b"
URL = r"(https?://[^\s]+|www\.[^\s]+)"
MAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9][0-9\-() ]{7,}[0-9]"
# Patterns of wrongly converted terms and their corrections.
ERRORS = [("kåñëa", "kṛṣṇa"), ("oā", "oṁ"), ("jṣā", "jñā"), ("ṣja", "ñja"), ("taā", "taṁ"), ("āṣś", "ṛṣṇ"), ("çré", "śrī"), ("®", "ṛ"), ("ß", "ṣ"), ("√", "ś"), ("ò", "ḍ"), ("†", "ṭ"), ("∫", "ṅ"), ("∂", "ḍ"), ("µ", "ṁ")]


def statistics(text: Column) -> dict[str, Column]:
    """Words, numbers, links, addresses, telephone numbers and title-like lines of a text."""
    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.trim(x))
    titled = F.filter(lines, lambda x: F.length(x).between(3, 80) & x.rlike(r"^([A-Z][A-Za-z']*\s*)+$"))
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    return {"words": count(r"\S+"), "numbers": count("[0-9]+"), "urls": count(URL), "mails": count(MAIL), "phones": count(PHONE), "titles": F.size(titled).cast("long"), "caps": F.size(F.filter(titled, lambda x: x.rlike("^[A-Z' ]+$"))).cast("long")}


def publisher_score(text: Column) -> Column:
    """Points of a publisher's page. The measures are taken once and bound to a name."""
    measured = F.struct(*[c.alias(k) for k, c in statistics(text).items()], F.lower(text).alias("low"))

    def points(s: Column) -> Column:
        links = s["urls"] + s["mails"] + s["phones"]
        signs = [(s["urls"] >= 3, 2), (s["mails"] >= 1, 1), (s["phones"] >= 3, 2), ((s["words"] <= 250) & (links >= 5), 3), ((s["numbers"] >= 30) & (s["words"] <= 500), 2), (s["titles"] >= 8, 2), (s["caps"] >= 4, 1)]
        signs += [(s["low"].contains("license") & s["low"].contains("creative"), 2)]
        signs += [(text.rlike("(?i)" + p), 3) for p in PUBLISHER] + [(text.rlike("(?i)" + OTHER), -2)]
        total = F.lit(0)
        for c, n in signs:
            total = total + F.when(c, n).otherwise(0)
        return total

    return F.element_at(F.transform(F.array(measured), points), 1)


def confidence(score: Column) -> Column:
    return F.when(score >= 9, "high").when(score >= 6, "medium").when(score >= 4, "low").otherwise("very_low")


def empty_page(text: Column) -> Column:
    t = F.coalesce(F.regexp_replace(text, r"^\s+|\s+$", ""), F.lit(""))
    return (F.length(t) <= 5) & (F.regexp_count(t, F.lit(r"\S+")) <= 2)


def term_errors(term: Column) -> Column:
    """One (pattern, corrected) for every wrong pattern in the term."""
    every = F.array(*[F.when(term.contains(a), F.struct(F.lit(a).alias("pattern"), F.replace(term, F.lit(a), F.lit(b)).alias("corrected"))) for a, b in ERRORS])
    return F.filter(every, lambda x: x.isNotNull())


def ending(text: Column) -> Column:
    """How a description ends, in exclusive classes."""
    last = F.right(F.rtrim(text), F.lit(1))
    return F.when(text.isNull() | (F.trim(text) == ""), "empty").when(last == ".", "full stop").when(last.isin("?", "!"), "other mark").when(last.isin(")", "]"), "bracket").when(last.isin(",", ";", ":"), "open mark").when(last.rlike("[0-9]"), "digit").otherwise("letter")


def whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def code_point(c: Column) -> Column:
    return F.format_string("U+%04X", F.ascii(c))


def complete(text: Column) -> Column:
    """Whether a description ends as one does: with a full stop or a closing bracket."""
    return F.coalesce(F.right(F.rtrim(text), F.lit(1)).isin(".", "]", ")"), F.lit(False))


def clean_summary(text: Column) -> Column:
    """A summary's text: runs of blank lines become one, other white space one space, lines are
    trimmed, and so are blank lines at both ends. NULL gives ''."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    t = F.regexp_replace(t, r"\n\s*\n\s*\n+", "\n\n")
    t = F.regexp_replace(t, r"[^\S\n]+", " ")
    return F.regexp_replace(F.regexp_replace(t, r"(?m)^ +| +$", ""), r"^\n+|\n+$", "")


def clean_list_line(text: Column) -> Column:
    """A line without bullets at its beginning and with runs of dots as one ellipsis."""
    return whitespace(F.regexp_replace(F.regexp_replace(text, r"^[\s•·▪◦*\-–—]+", ""), r"\.{3,}|…", "…"))


def verse_lines(text: Column) -> Column:
    """Text of a verse index: leaders of three dots or more, also spaced ones, become five, and lines
    have no white space at their ends. Glyphs are mapped before (map_glyphs)."""
    t = F.regexp_replace(text, r"(?:\.\s*){3,}", ".....")
    return F.array_join(F.transform(F.split(t, r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, r"\s+$", "")), "\n")


# Signs that end a word's context.
DELIMITERS = r" \n\r\t.,;:!?()\[\]{}"


def word_contexts(text: Column, char: str) -> Column:
    """The words around every place of a character, from delimiter to delimiter; a word that has it
    twice comes once."""
    return F.regexp_extract_all(text, F.lit(f"[^{DELIMITERS}]*{char}[^{DELIMITERS}]*"), F.lit(0))


def safe_string(value: Column) -> Column:
    """Any value as trimmed text, NULL as ''."""
    return F.coalesce(F.trim(value.cast("string")), F.lit(""))


def clean_value(text: Column) -> Column:
    """Trimmed text, NULL where nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def image_extension(data: Column) -> Column:
    """File extension by the first bytes of an image; png where they aren't known."""
    head = F.hex(F.substring(data, 1, 12))
    return F.when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("89504E47"), "png").when(head.startswith("474946"), "gif").when(head.startswith("52494646") & head.endswith("57454250"), "webp").when(head.startswith("49492A00") | head.startswith("4D4D002A"), "tiff").otherwise("png")


def data_uri(data: Column) -> Column:
    """An image inline, with its type."""
    return F.concat(F.lit("data:image/"), image_extension(data), F.lit(";base64,"), F.base64(data))


def preview(text: Column, size: int = 50) -> Column:
    return F.left(text, F.lit(size))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def default_name(stem: str, filters: dict[str, object], stamp: str, extension: str = "csv") -> str:
    """File name of a report: its filters that are set, in order, and the time it was made."""
    parts = [stem, *[f"{k}_{v}" for k, v in filters.items() if v not in (None, "", [])], stamp]
    return "_".join(str(p).replace(" ", "_") for p in parts) + f".{extension}"

"""Functions that need Python's character data, batch-wise over Arrow."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Composed form; NULL stays."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(StringType())
def sort_key(s: pd.Series) -> pd.Series:
    """Letters, digits and spaces without their marks, in lower case."""
    return s.map(lambda x: None if x is None else " ".join("".join(c for c in unicodedata.normalize("NFKD", x) if c.isalnum() or c == " ").split()).lower())


def hex_label(label: Column) -> Column:
    """Label with its <hex> chunks decoded: UTF-16 with a byte order mark, else UTF-8; a chunk that
    isn't hex stays as it is."""
    chunks = F.regexp_extract_all(label, F.lit("<([0-9A-Fa-f]+)>"), F.lit(1))

    def put(text: Column, chunk: Column) -> Column:
        raw = F.unhex(chunk)
        new = F.when(F.upper(chunk).startswith("FEFF"), F.decode(raw, "UTF-16")).otherwise(F.decode(raw, "UTF-8"))
        return F.replace(text, F.concat(F.lit("<"), chunk, F.lit(">")), new)

    return F.aggregate(chunks, label, put)

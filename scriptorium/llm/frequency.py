"""Frequency of every distinct term, in a vertical layout.

A term's records are a sparse bitmap: of all 64-bit words of the id space only those with a bit
set exist, one row (term, space, word, bits, occurrences) each. Bitmaps are built and merged by
bitwise union, so a record counts once however often it is met, and the document frequency is
their cardinality. A hot term is spread over as many words as its records need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import current, current_sql, load

COMMON = 0.01  # share of all records from which a term is common


def is_term(c: Column) -> Column:
    """Neither NULL nor empty nor white space (of any kind) alone."""
    return c.rlike(r"(?U)\S")


def postings(rows: DataFrame) -> DataFrame:
    """rows: term, space int (the id space, such as a table), id bigint, occurrences bigint.

    Returns the bitmap words. Rows without a term are left out; a NULL count is one occurrence;
    a NULL id is a record of its own; repeated rows add occurrences but no record.
    """
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    return (
        rows.where(is_term(F.col("term")))
        .withColumn("id", F.coalesce("id", F.lit(-(1 << 62))))
        .groupBy("term", "space", F.shiftright("id", 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"), F.sum(F.coalesce("occurrences", F.lit(1))).cast("long").alias("occurrences"))
    )


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of two sets of postings, as of two days or partitions."""
    return left.unionByName(right).groupBy("term", "space", "word").agg(F.bit_or("bits").alias("bits"), F.sum("occurrences").alias("occurrences"))


def frequencies(words: DataFrame) -> DataFrame:
    """Occurrences and records of every term."""
    return words.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum(F.bit_count("bits").cast("long")).alias("records"))


def marked(freq: DataFrame, total: int, common: float = COMMON) -> DataFrame:
    """``rare`` (one occurrence) and ``common`` (in at least that share of all records)."""
    return freq.withColumn("rare", F.col("occurrences") == 1).withColumn("common", F.col("records") / F.lit(max(1, total)) >= F.lit(common))


def _frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    bank = current(spark, sf_dir, "pbb_word_bank", ["word_id", "raw_word"]).select(F.col("raw_word").alias("term"), F.lit(0).alias("space"), F.col("word_id").alias("id"), F.lit(1).cast("long").alias("occurrences"))
    amb = current(spark, sf_dir, "ambiguous_diacritic_words", ["id", "word", "occurrence_count"]).select(F.col("word").alias("term"), F.lit(1).alias("space"), "id", F.col("occurrence_count").cast("long").alias("occurrences"))
    total = load(spark, sf_dir, "pbb_word_bank").select("word_id").distinct().count() + load(spark, sf_dir, "ambiguous_diacritic_words").select("id").distinct().count()
    return marked(frequencies(postings(bank.unionByName(amb))), total)


def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term with its occurrences, records and marks."""
    return _frequencies(spark, sf_dir)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _frequencies(spark, sf_dir)
    return f.select("term", F.explode(F.filter(F.array(F.when(F.col("rare"), "rare"), F.when(F.col("common"), "common")), lambda m: m.isNotNull())).alias("mark"))


QUERIES = {"p2_terms": p2_terms, "p2_found": p2_found}

_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TERMS = f"""
WITH r AS MATERIALIZED (SELECT raw_word AS term, 1 AS n FROM {current_sql("pbb_word_bank")}
  UNION ALL SELECT word, coalesce(occurrence_count, 1) FROM {current_sql("ambiguous_diacritic_words")}),
f AS (SELECT term, CAST(sum(n) AS BIGINT) AS occurrences, count(*) AS records FROM r WHERE regexp_replace(term, '{_WS}', '', 'g') <> '' GROUP BY term),
m AS (SELECT *, occurrences = 1 AS rare, records >= {COMMON} * (SELECT count(*) FROM r) AS common FROM f)
"""
ORACLE = {
    "p2_terms": _TERMS + "SELECT * FROM m",
    "p2_found": _TERMS + "SELECT term, 'rare' AS mark FROM m WHERE rare UNION ALL SELECT term, 'common' FROM m WHERE common",
}

"""References to records that do not exist.

Keys of referring and referred rows are dictionary-encoded as integers. The integers are laid out
in key ranges; within a range 64 neighbouring codes and one period (month) make one word of a
sparse bitmap, of which only words with a bit set exist. Every range keeps, per period, the bitmap
of keys referred to and the union of the bitmaps of keys that were there before the period. What
remains of ``references AND NOT parents`` is decoded to keys again; only rows that refer to those
are compared by their exact times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGES = 4096  # key ranges of the dictionary, at least
RANGE_ROWS = 20_000  # rows of either table in a range, about
SALTS = 16  # ways in which the rows of one hot key are spread


def trimmed_label(label: Column) -> Column:
    """Label without white space of any kind at its ends, in lower case."""
    return F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))


def ranges_for(rows: int) -> int:
    """Key ranges for tables of so many rows: a range stays small whatever their size."""
    return max(RANGES, rows // RANGE_ROWS)


def _period(ts: Column) -> Column:
    """Month as yyyymm; 0, before all others, where the time is missing."""
    return F.coalesce(F.year(ts) * 100 + F.month(ts), F.lit(0))


def orphans(refs: DataFrame, parents: DataFrame, keys: list[str], *, ranges: int = RANGES, salts: int = SALTS) -> DataFrame:
    """Rows of ``refs`` whose key no live row of ``parents`` had when they were made.

    refs: row_id bigint, ts timestamp, the key columns and any others. parents: the key columns,
    ts timestamp, live boolean. A parent counts if it is live and its ts is not after that of the
    reference. Returns the rows of ``refs`` with ``kind``: ``late`` (a live parent came later),
    ``deleted`` (only deleted rows have the key) or ``missing``.

    A NULL in a key never matches, a parent without ts never counts and a reference without ts is
    an orphan. Repeated rows of refs are kept, repeated parents have no effect; either table may be
    empty. Further columns are kept, but one named kind gives way to the result's.
    """
    key = F.xxhash64(*keys)
    have = parents.groupBy(*keys).agg(F.min(F.when(F.col("live"), F.col("ts"))).alias("_since"))
    # Combined before the shuffle: a hot key has at most one row for each period.
    asked = refs.groupBy(*keys, _period(F.col("ts")).alias("_period")).agg(F.lit(1).alias("_ref"))
    both = asked.select(*keys, "_period", "_ref", F.lit(None).cast(parents.schema["ts"].dataType).alias("_since"), F.lit(0).alias("_par")).unionByName(
        have.select(*keys, F.coalesce(_period(F.col("_since")), F.lit(0)).alias("_period"), F.lit(0).alias("_ref"), "_since", F.lit(1).alias("_par"))
    )
    both = both.withColumn("_range", F.pmod(key, F.lit(ranges)).cast("int"))
    in_range = W.partitionBy("_range").orderBy(*keys)
    of_key = W.partitionBy("_range", *keys)
    coded = (
        both.withColumn("_code", F.dense_rank().over(in_range).cast("long") - 1)
        .withColumn("_since", F.max("_since").over(of_key))
        .withColumn("_known", F.max("_par").over(of_key))
        .withColumn("_full", F.lit(True) if not keys else ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    )
    bit = F.expr("shiftleft(1L, cast(_code & 63 as int))")
    words = coded.groupBy("_range", F.shiftright("_code", 6).alias("_word"), "_period").agg(
        F.bit_or(F.when(F.col("_ref") == 1, bit).otherwise(F.lit(0).cast("long"))).alias("_asked"),
        F.bit_or(F.when((F.col("_par") == 1) & F.col("_since").isNotNull() & F.col("_full"), bit).otherwise(F.lit(0).cast("long"))).alias("_there"),
    )
    before = W.partitionBy("_range", "_word").orderBy("_period").rowsBetween(W.unboundedPreceding, -1)
    left = words.withColumn("_open", F.col("_asked").bitwiseAND(F.bitwise_not(F.coalesce(F.bit_or("_there").over(before), F.lit(0).cast("long"))))).where("_open != 0")
    open_codes = left.select("_range", "_period", F.explode(F.expr("filter(sequence(0, 63), b -> getbit(_open, b) = 1)")).alias("_b"), "_word").select(
        "_range", "_period", (F.shiftleft("_word", 6) + F.col("_b")).alias("_code")
    )
    open_keys = coded.where("_ref = 1").join(open_codes, ["_range", "_period", "_code"]).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_period").alias("_p"), "_since", "_known", "_full")
    spread = open_keys.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = refs.withColumn("_s0", F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int")).withColumn("_p0", _period(F.col("ts")))
    on = [F.col("_s0") == F.col("_s"), F.col("_p0") == F.col("_p")] + [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    hit = salted.join(spread, on)
    bad = hit.where(~F.col("_full") | F.col("_since").isNull() | F.col("ts").isNull() | (F.col("_since") > F.col("ts")))
    kind = F.when(F.col("_since").isNotNull() & F.col("_full"), "late").when((F.col("_known") == 1) & F.col("_full"), "deleted").otherwise("missing")
    return bad.select(*[refs[c] for c in refs.columns if c != "kind"], kind.alias("kind"))


def by_period(found: DataFrame, refs: DataFrame) -> DataFrame:
    """References and orphans of each kind per table and month."""
    all_ = refs.groupBy("src_table", F.date_format("ts", "yyyy-MM").alias("period")).agg(F.count("*").alias("refs"))
    bad = found.groupBy("src_table", F.date_format("ts", "yyyy-MM").alias("period")).agg(
        F.count("*").alias("orphans"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("missing", "deleted", "late")]
    )
    return (
        all_.alias("a")
        .join(bad.alias("b"), F.expr("a.src_table <=> b.src_table and a.period <=> b.period"), "left")
        .select("a.src_table", "a.period", "refs", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("orphans", "missing", "deleted", "late")])
    )

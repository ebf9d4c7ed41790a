"""Mixing sources to target weights by weighted fair queueing.

The records of a source are shuffled (by a hash of id, pass and seed) and repeated pass after pass
up to the source's limit. A record's virtual finish time is the source's cumulative tokens divided
by its weight; in the order of those times every prefix has the target proportions. All records are
ranked by it over ranges and cut off at the total budget. Running sums are kept in two levels, over
slices of the shuffle order and within a slice, so no source or range is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise
from ..tables import load
from .tokens import document_sizes

SLICE = 50_000  # records of one slice or range, about
SEED = 7


def per_source(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, have (tokens), longest: one row per source that takes part."""
    t = targets.where("target_share > 0 and max_repeats > 0").select("source", "target_share", "max_repeats")
    return sizes.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("have"), F.max("tokens").alias("longest")).join(t, "source")


def budget_of(sizes: DataFrame, targets: DataFrame) -> float:
    """The default total: all tokens of the sources that take part."""
    return float(per_source(sizes, targets).agg(F.sum("have")).first()[0] or 0)


def end_time(sources: list, budget: float) -> float:
    """Virtual time at which the sources have given ``budget`` tokens; sources that have used up
    their repeats give no more, and the rest go on at their shares. Infinite: all is given before.

    sources: (target_share, max_repeats, have)."""
    at, given, live = 0.0, 0.0, sum(s for s, _, _ in sources)
    for share, repeats, have in sorted(sources, key=lambda x: x[1] * x[2] / x[0]):
        out = repeats * have / share
        if given + live * (out - at) >= budget:
            return at + (budget - given) / live
        given += live * (out - at)
        at, live = out, live - share
    return float("inf")


def mix(sizes: DataFrame, targets: DataFrame, budget: float | None = None, *, slice_rows: int = SLICE, seed: int = SEED) -> DataFrame:
    """sizes: doc_id, source, tokens. targets: source (unique), target_share, max_repeats.

    Returns position (from 1), doc_id, source, copy (from 1), tokens, virtual_time: the longest
    prefix of the fair order whose tokens don't exceed ``budget`` (default: see budget_of). A
    source without records has no part, and the others keep their proportions to each other; once
    a source has used up its repeats it falls short of its share and the rest go on without it.
    Sources without a target, records without tokens and shares or repeats that are NULL or not
    positive are left out. Other columns of either table have no effect.

    What each source can give, one row per source with a target, is known to the driver; from it
    follows how many passes over a source can be met before the budget ends, and no more copies
    than that are made.
    """
    sizes = sizes.select("doc_id", "source", "tokens")
    # At most one row for each row of the table of targets.
    have = per_source(sizes, targets).collect()
    if budget is None:
        budget = float(sum(r["have"] for r in have))
    # Records end a little after their tokens are due: by one record of each source at most.
    stop = end_time([(r["target_share"], r["max_repeats"], r["have"]) for r in have], budget + sum(r["longest"] for r in have))
    passes = [(r["source"], r["target_share"], int(min(r["max_repeats"], stop * r["target_share"] / r["have"] + 1))) for r in have]
    spark = sizes.sparkSession
    t = spark.createDataFrame(passes, "source string, target_share double, passes int")
    n = sizes.count()
    slices = max(1, n // slice_rows)
    rows = (
        sizes.where("tokens > 0 and source is not null")
        .join(F.broadcast(t), "source")
        .withColumn("copy", F.explode(F.expr("sequence(1, passes)")))
        .withColumn("h", F.xxhash64("doc_id", "copy", F.lit(seed)))
        .withColumn("slice", F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * slices).cast("int"))
    )
    sums = rows.groupBy("source", "target_share", "copy", "slice").agg(F.sum("tokens").alias("of_slice"))
    before = W.partitionBy("source").orderBy("copy", "slice").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("of_slice").over(before), F.lit(0).cast("long"))).where(F.col("before") / F.col("target_share") <= F.lit(stop)).select("source", "copy", "slice", "before")
    inside = W.partitionBy("source", "copy", "slice").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    timed = rows.join(sums, ["source", "copy", "slice"]).select("doc_id", "source", "copy", "tokens", ((F.col("before") + F.sum("tokens").over(inside)) / F.col("target_share")).alias("virtual_time"))
    timed = materialise(timed.where(F.col("virtual_time") <= F.lit(stop)))
    last = timed.agg(F.max("virtual_time").alias("end"), F.count("*").alias("n")).first()
    ranges = max(1, 2 * last["n"] // slice_rows)
    timed = timed.withColumn("range", F.least(F.lit(ranges - 1), F.floor(F.col("virtual_time") / F.lit(last["end"] or 1.0) * ranges)).cast("int"))
    # One row per range.
    hist = timed.groupBy("range").agg(F.sum("tokens").alias("of_range"), F.count("*").alias("n"))
    upto = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    hist = hist.select("range", F.coalesce(F.sum("of_range").over(upto), F.lit(0).cast("long")).alias("before"), F.coalesce(F.sum("n").over(upto), F.lit(0).cast("long")).alias("ranked")).where(F.col("before") <= F.lit(budget))
    order = W.partitionBy("range").orderBy("virtual_time", "source", "doc_id", "copy")
    ranked = timed.join(hist, "range").withColumn("position", F.col("ranked") + F.row_number().over(order)).withColumn("total", F.col("before") + F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return ranked.where(F.col("total") <= F.lit(budget)).select("position", "doc_id", "source", "copy", "tokens", "virtual_time")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and actual share, records, repeats and tokens of every source with a target, and what
    it falls short of its share (0 where it doesn't)."""
    per = mixture.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count_distinct("doc_id").alias("records"), F.count("*").alias("uses"), F.max("copy").alias("most_uses"))
    # One row per source.
    all_ = per.agg(F.sum("tokens").alias("all_tokens")).withColumn("_one", F.lit(1))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("tokens", "records", "uses", "most_uses")]
    return targets.select("source", "target_share", "max_repeats").join(per, "source", "left").withColumn("_one", F.lit(1)).join(F.broadcast(all_), "_one", "left").select("source", "target_share", "max_repeats", *zero, F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share")).withColumn("shortfall", F.greatest(F.lit(0.0), F.coalesce("target_share", F.lit(0.0)) - F.col("actual_share")))


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = load(spark, sf_dir, "mix_targets")
    return mix(document_sizes(spark, sf_dir), targets), targets


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture: every use of a record, in order."""
    return _mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(*_mixture(spark, sf_dir))


QUERIES = {"p9_mixture": p9_mixture, "p9_shares": p9_shares}
ORACLE: dict[str, str] = {}

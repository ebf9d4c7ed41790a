"""Changes to tables as pure functions of the old and the new rows, and thin sinks.

Every change is first a DataFrame (so a dry run is that DataFrame); a sink then writes the whole new
version of the table to a directory of its own, which readers see only when it is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows of new replace rows of old with the same key; a column new hasn't or has NULL in keeps
    its old value. Of repeated keys in new the last row by ``order`` counts, the last as read where
    no order is given."""
    rest = [c for c in new.columns if c not in keys]
    at = F.col(order) if order else F.monotonically_increasing_id()
    n = new.withColumn("_at", at).groupBy(*keys).agg(F.max_by(F.struct(F.lit(0).alias("_z"), *rest), "_at").alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
    cols = [c for c in old.columns if c not in keys]
    have = [c for c in cols if c in new.columns]
    n = n.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_n_{c}") for c in have], F.lit(1).alias("_new"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    j = old.withColumn("_old", F.lit(1)).join(n, on, "full_outer")
    out = [F.when(F.col("_old").isNotNull(), F.col(k)).otherwise(F.col(f"_k{i}")).alias(k) for i, k in enumerate(keys)] + [(F.coalesce(F.col(f"_n_{c}"), F.col(c)) if c in have else F.col(c)).alias(c) for c in cols]
    return j.select(*out).select(*old.columns)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose key old doesn't have, one for each key."""
    return new.join(old.select(*keys).distinct(), keys, "left_anti").dropDuplicates(keys)


def with_ids(old: DataFrame, new: DataFrame, id_: str, order: list[str]) -> DataFrame:
    """New rows with ids after the largest old one, in the given order.

    Ranks are counted per slice of the order and added up, so no task sees all rows."""
    top = old.agg(F.coalesce(F.max(id_), F.lit(0))).first()[0]
    n = max(1, new.sparkSession.sparkContext.defaultParallelism)
    # Written before it is counted: slices that were cut twice needn't be the same.
    cut = materialise(new.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    first = cut.groupBy("_p").agg(F.count("*").alias("_c"), F.min("_m").alias("_f"))
    first = first.withColumn("_b", F.coalesce(F.sum("_c").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")))
    return cut.join(first, "_p").withColumn(id_, F.lit(top) + F.col("_b") + F.col("_m") - F.col("_f") + 1).select(id_, *[c for c in new.columns if c != id_])


def replace_groups(old: DataFrame, new: DataFrame, group: list[str]) -> DataFrame:
    """Old rows of groups that new has are given up for new's."""
    return old.join(new.select(*group).distinct(), group, "left_anti").unionByName(new)


def update(old: DataFrame, changes: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """Column set to the change's value where there is one that differs."""
    c = changes.select(F.col(key).alias("_k"), F.col(value).alias("_v"), F.lit(1).alias("_c")).dropDuplicates(["_k"])
    return old.join(c, F.col(key) == F.col("_k"), "left").withColumn(column, F.when(F.col("_c").isNotNull(), F.col("_v")).otherwise(F.col(column))).select(*old.columns)


def append(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new after those of old. A key that is there already, or twice in new, is an error, as
    where a table has a unique key."""
    twice = old.select(*keys).unionByName(new.select(*keys)).groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"rows whose key exists: {twice.select(*keys).first()}")
    return old.unionByName(new.select(*old.columns))


def create_if_absent(spark: SparkSession, path: str, schema: StructType) -> bool:
    """An empty table of the schema unless there is one; whether it was made."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return False
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a whole new version of a table; the version directory appears when it is complete."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path

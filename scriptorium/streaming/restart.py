"""Loading that goes on where it stopped: new files are kept batch by batch and merged when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.store import upsert, write_version


def load_new_files(spark: SparkSession, source: str, schema: StructType, target: str, keys: list[str], checkpoint: str) -> int:
    """Keep all files of ``source`` that weren't loaded before as batches under ``target``; returns the
    number of new ones. Of a key that a batch has more than once the last row is kept. The checkpoint
    remembers what was read; a batch repeated after a failure writes the same folder again. A batch
    costs what it holds, whatever the table's size."""
    done: list[int] = []

    def batch(df: DataFrame, n: int) -> None:
        one = upsert(spark.createDataFrame([], schema), df, keys)
        write_version(one.withColumn("_batch", F.lit(n).cast("long")), f"{target}/batch={n}")
        done.append(n)

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(done)


def merged(spark: SparkSession, target: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The table as it is after all batches: of every key the newest value of each column that isn't
    NULL."""
    full = StructType([*schema.fields]).add("_batch", "long")
    rows = spark.read.schema(full).option("recursiveFileLookup", "true").parquet(target)
    rest = [f.name for f in schema.fields if f.name not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_batch"))).alias(c) for c in rest]).select(*[f.name for f in schema.fields])


def compact(spark: SparkSession, target: str, schema: StructType, keys: list[str], path: str) -> str:
    """Write the merged table to a folder of its own."""
    return write_version(merged(spark, target, schema, keys), path)

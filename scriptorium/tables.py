"""Table access: loading, current rows and the schemas of the corpus tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import materialise

#: Key and recency column of each corpus table.
KEYS: dict[str, tuple[tuple[str, ...], str]] = {
    "content": (("content_id",), "updated_at"),
    "page_map": (("book_id", "page_number"), "created_at"),
    "table_of_contents": (("toc_id",), "created_at"),
    "glossary": (("glossary_id",), "created_at"),
    "glossary_embeddings": (("glossary_id",), "updated_at"),
    "dangerous_glyph_words": (("id",), "created_at"),
    "ambiguous_diacritic_words": (("id",), "created_at"),
    "pbb_word_bank": (("word_id",), "created_at"),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def recency(name: str) -> Column:
    """Recency as microseconds; a missing time is the oldest of all."""
    return F.coalesce(F.unix_micros(F.col(KEYS[name][1]).cast("timestamp")), F.lit(-(1 << 62)))


def latest(df: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str]) -> DataFrame:
    """For each key the values of ``columns`` in the row with the largest ``order``.

    An aggregation, not a window: copies of one key are combined before the shuffle, so a key
    that holds a large part of all rows costs no more than any other. Rows whose key is NULL form
    one key. Rows that tie must be identical; one of them is kept.
    """
    rest = [c for c in columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    got = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return got.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


#: Columns whose values are long: rows with them stay where they are.
WIDE = {"content": ("page_content", "ai_page_content")}


def superseded(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """_file, _row of all rows but the one that counts for each key. df: with _file and _row.

    Only keys, times and places are shuffled; what comes back is as many rows as are out of date."""
    narrow = df.select(*keys, order.alias("_t"), F.struct("_file", "_row").alias("_at"))
    many = materialise(narrow.groupBy(*keys).agg(F.max_by("_at", "_t").alias("_now"), F.count("*").alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_now"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return materialise(narrow.join(many, on).where("_at <> _now").select("_at._file", "_at._row"))


def current(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    """Current rows of a corpus table, only the named columns (pruned at the scan).

    Rows with long values aren't shuffled: those out of date are taken off at the scan by their place
    in the files. How many they are is known by then, so Spark broadcasts them if their size permits
    and joins by sorting if not. Filters on the result reach the scan."""
    keys, ts = KEYS[name]
    df = load(spark, sf_dir, name)
    if not set(columns) & set(WIDE.get(name, ())):
        return latest(df, list(keys), recency(name), list(columns))
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    old = superseded(df.select(*keys, ts, *place), list(keys), recency(name))
    return spread(df.select(*columns, *place)).join(old, ["_file", "_row"], "left_anti").select(*columns)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the files are fewer than those, as small tables are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def current_sql(name: str) -> str:
    """The same as a DuckDB subquery."""
    keys, ts = KEYS[name]
    return f"(SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ts} DESC NULLS LAST) = 1)"

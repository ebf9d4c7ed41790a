"""Readers and writers of the library's files."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """CSV with a header; rows that don't fit come with their text in ``_bad``, all with ``_file``."""
    full = StructType([*schema.fields]).add("_bad", "string")
    df = spark.read.csv(path, schema=full, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", multiLine=False, enforceSchema=True)
    return df.withColumn("_file", F.input_file_name())


def toc_files(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All ``*_toc.csv`` and ``toc_*.csv`` of a folder, each file once; the reader finds them itself."""
    full = StructType([*schema.fields]).add("_bad", "string")
    df = spark.read.schema(full).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True, pathGlobFilter="{toc_*,*_toc}.csv").csv(folder)
    return df.withColumn("_file", F.input_file_name())


def pairs_by_number(left: DataFrame, right: DataFrame) -> DataFrame:
    """Files (``path``) of two folders whose names begin with the same digits."""
    a = left.select(F.col("path").alias("left_path"), F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^([0-9]+)", 1).alias("number")).where("number <> ''")
    b = right.select(F.col("path").alias("right_path"), F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"^([0-9]+)", 1).alias("number")).where("number <> ''")
    return a.join(b, "number")


def last_value(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Key to value; of repeated keys the last row's."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def merge_pairs(raw: DataFrame, fixed: DataFrame) -> DataFrame:
    """Words of both lists (number, word, value); of a word in several pairs the first pair's."""
    j = raw.join(fixed, ["number", "word"], "full_outer")
    return j.withColumn("_k", F.row_number().over(W.partitionBy("word").orderBy("number"))).where("_k = 1").drop("_k")


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of the files under a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], parts: int, **options: str) -> DataFrame:
    """A database table read in parts of a key's range."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, **options).load()


def connection(env: dict[str, str]) -> dict[str, str]:
    """Options of a database connection: DATABASE_URL, else the DB_ settings."""
    if url := env.get("DATABASE_URL"):
        u = urlsplit(url)
        found = {"host": u.hostname, "port": u.port or 5432, "name": u.path.lstrip("/"), "user": u.username, "password": u.password}
    else:
        found = {"host": env.get("DB_HOST", "localhost"), "port": env.get("DB_PORT", "5432"), "name": env.get("DB_NAME"), "user": env.get("DB_USER"), "password": env.get("DB_PASSWORD")}
    if not found["name"]:
        raise ValueError("DATABASE_URL or DB_NAME must be set")
    rest = {k: unquote(str(found[k])) for k in ("user", "password") if found[k]}
    return {"url": f"jdbc:postgresql://{found['host']}:{found['port']}/{found['name']}", **rest}


def write_jdbc(df: DataFrame, url: str, table: str, parts: int = 8, batch: int = 1000, **options: str) -> None:
    """Rows after those of a database table: at most ``parts`` connections, each of which commits once
    or not at all."""
    df.coalesce(parts).write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=batch, isolationLevel="READ_COMMITTED", **options).save()


def reachable(spark: SparkSession, **connect: str) -> bool:
    """Whether the session, and the database where one is named, answer."""
    try:
        if connect:
            return spark.read.format("jdbc").options(query="select 1 as one", **connect).load().first()[0] == 1
        return spark.sql("select 1").first()[0] == 1
    except Exception:  # noqa: BLE001 - any failure means no
        return False


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SQL with named parameters."""
    return spark.sql(sql, args=args)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def metadata_dates(raw):
    """A document date 'D:YYYYMMDDHHMMSS', 'D:YYYYMMDD' or 'D:YYYYMM' as timestamp; NULL where it isn't
    one. A zone after it is left out."""
    d = F.regexp_extract(raw, r"^(?:D:)?([0-9]{4,14})", 1)
    return F.coalesce(*[F.try_to_timestamp(F.when(F.length(d) >= n, F.left(d, F.lit(n))), F.lit(f)) for n, f in ((14, "yyyyMMddHHmmss"), (8, "yyyyMMdd"), (6, "yyyyMM"))])


def metadata_date_text(raw):
    """The same as text, the value itself where it is no date."""
    return F.coalesce(F.date_format(metadata_dates(raw), "yyyy-MM-dd HH:mm:ss"), raw)


def manifest(tasks: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Tasks with whether their file exists."""
    f = files.select(F.col(key).alias("_k"), F.lit(True).alias("_have")).dropDuplicates(["_k"])
    return tasks.join(f, F.col(key) == F.col("_k"), "left").withColumn("exists", F.coalesce("_have", F.lit(False))).drop("_k", "_have")


def copies(tasks: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """source, target, state of files to be copied under other names: ``copy``, ``missing`` (no such
    file) or ``error`` (no name to copy to)."""
    m = manifest(tasks, files, key)
    state = F.when(F.coalesce(F.trim("target"), F.lit("")) == "", "error").when(F.col("exists"), "copy").otherwise("missing")
    return m.select(F.col(key).alias("source"), "target", state.alias("state"))


def write_text(df: DataFrame, path: str, text: str) -> None:
    """Lines of one column, such as a report or a page of HTML a line."""
    df.select(text).write.mode("overwrite").text(path)

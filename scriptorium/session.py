"""Spark session factory and the shared working folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "scriptorium", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator relies on; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a private one in a session of
    one machine (tests); on a cluster, where every executor would write to its own disk, an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="scriptorium-"))
        at = "file://" + _local[0]
    return at


def materialise(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    Parquet in a folder that every executor reaches survives the loss of executors. The files
    are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/scriptorium-{uuid.uuid4().hex}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    except Exception:
        if path.startswith("file://" + tempfile.gettempdir()) and os.path.isdir(path[7:]):
            import shutil

            shutil.rmtree(path[7:], ignore_errors=True)

"""Event-time windows (an extension: batch libraries of this kind have none)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counted(events: DataFrame, ts: str = "ts", key: str = "event_type", length: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Events and sums per key and tumbling (or sliding) window; works on streams and tables.
    Rows later than ``late`` behind the newest are dropped from a stream, not from a table."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark(ts, late)
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return e.groupBy(w.alias("w"), key).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), key, "n", "total")


def sessions(events: DataFrame, ts: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark(ts, late)
    return e.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), key, "n")

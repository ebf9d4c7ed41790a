"""Filling containers of fixed capacity, in a mixture that is the same all along.

Texts are spread over partitions by a hash. In each a deficit round robin over the sources' queues
fills window after window to the target proportions of tokens; what a source got too much or too
little is carried into the next window, and from the partitions before into the first window. The
items of a window are placed best fit, longest first, into the containers that are still open, so
room left by one window is filled by the next. Only a text longer than the capacity is split: into
full containers and a rest that is an item like any other.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..tables import load
from .tokens import document_sizes

PARTITION_TOKENS = 4_000_000  # tokens packed in one task
WINDOW = 128  # containers filled by one window
SEED = 11


def drr(sizes: np.ndarray, source: np.ndarray, share: dict, deficit: dict, window: float) -> list[list[int]]:
    """Positions of the items in windows of about ``window`` tokens, by deficit round robin.

    Items of a source keep their order. A source may overdraw by part of one item; it starts the
    next window with that debt. When some sources are empty the others go on."""
    queues = {s: list(np.flatnonzero(source == s)[::-1]) for s in share}
    owed = {s: deficit.get(s, 0.0) for s in share}
    out = []
    while any(queues.values()):
        got: list[int] = []
        live = [s for s in queues if queues[s]]
        scale = window / sum(share[s] for s in live)
        for s in live:
            owed[s] += share[s] * scale
            q = queues[s]
            while q and (owed[s] > 0 or sizes[q[-1]] == 0):
                got.append(q.pop())
                owed[s] -= sizes[got[-1]]
        if got:
            out.append(got)
    return out


class Bins:
    """Open containers, kept by their free room."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.free, self.n = capacity, [], 0

    def new(self) -> int:
        self.n += 1
        return self.n - 1

    def put(self, size: int) -> int:
        i = bisect.bisect_left(self.free, (size, -1))
        if i < len(self.free):
            room, b = self.free.pop(i)
        else:
            room, b = self.capacity, self.new()
        if room > size:
            bisect.insort(self.free, (room - size, b))
        return b


def _packer(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cap = int(pdf["capacity"].iat[0])
        pdf = pdf.sort_values(["shuffle", "doc_id"], kind="stable").reset_index(drop=True)
        tokens = pdf["tokens"].to_numpy("int64")
        full = np.where(tokens > cap, tokens // cap, 0)
        rest = tokens - full * cap
        src = pdf["source"].fillna("").to_numpy(object)
        share = dict(zip(pdf["source"].fillna(""), pdf["share"]))
        owed = dict(zip(pdf["source"].fillna(""), pdf["deficit"]))
        # All of a text counts for its source, also the full containers it fills alone.
        bins, doc, piece, size, box = Bins(cap), [], [], [], []
        for got in drr(tokens, src, share, owed, float(window * cap)):
            for i in got:
                for k in range(full[i]):
                    doc.append(i), piece.append(k), size.append(cap), box.append(bins.new())
            for i in sorted(got, key=lambda i: (-rest[i], i)):
                if rest[i] or not full[i]:
                    doc.append(i), piece.append(full[i]), size.append(rest[i]), box.append(bins.put(rest[i]))
        return pd.DataFrame({"capacity_tokens": cap, "container_id": (np.int64(pdf["part"].iat[0]) << 32) + np.array(box, "int64"), "doc_id": pdf["doc_id"].to_numpy()[doc], "piece": piece, "tokens": size})

    return run


def carried(held: DataFrame, share: DataFrame) -> DataFrame:
    """held: source, part, held (tokens). share: source, share. Adds share and deficit: what the
    partitions before left the source short of (or gave too much), which is its share of all their
    tokens, also of those that have none of it, less what it had there."""
    upto = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    # One row per partition of PARTITION_TOKENS.
    of_part = held.groupBy("part").agg(F.sum("held").alias("all")).select("part", F.coalesce(F.sum("all").over(upto), none).alias("all"))
    own = F.coalesce(F.sum("held").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), none)
    return held.withColumn("own", own).join(of_part, "part").join(share, "source").select("source", "part", "share", (F.col("share") * F.col("all") - F.col("own")).alias("deficit"))


def pack(sizes: DataFrame, capacities: list[int], *, share: DataFrame | None = None, partition_tokens: int = PARTITION_TOKENS, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """sizes: doc_id, source, tokens (not NULL). Returns capacity_tokens, container_id, doc_id,
    piece (from 0), tokens.

    ``share`` (source, share) gives target proportions of tokens; by default, as every text has to
    be placed, those of all texts. Sources without one get the smallest share; NULL is a source. A
    text of no tokens is placed in an open container or one of its own. Repeated rows are packed as
    often as they come; no rows, no containers. Capacities under 1 aren't possible.
    """
    total = sizes.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not total["n"]:
        total = {"t": 0, "n": 0}
    parts = max(1, -(-int(total["t"] or 0) // partition_tokens))
    s = sizes.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "tokens", F.xxhash64("doc_id", F.lit(seed)).alias("shuffle"))
    s = s.withColumn("part", F.pmod(F.xxhash64("shuffle", F.lit(seed + 1)), F.lit(parts)).cast("int"))
    held = s.groupBy("source", "part").agg(F.sum("tokens").alias("held"))
    if share is None:
        share = held.groupBy("source").agg((F.sum("held") / F.lit(max(1, int(total["t"] or 0)))).alias("share"))
    else:
        share = held.select("source").distinct().join(share.select(F.coalesce("source", F.lit("")).alias("source"), "share"), "source", "left")
    share = share.withColumn("share", F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(1e-9)))
    start = carried(held, share)
    rows = s.join(start, ["source", "part"]).withColumn("capacity", F.explode(F.array(*[F.lit(int(c)) for c in capacities])))
    return rows.groupBy("capacity", "part").applyInPandas(_packer(window), "capacity_tokens int, container_id long, doc_id long, piece int, tokens int")


def fill(packed: DataFrame) -> DataFrame:
    """Containers, tokens and share of room used, per capacity."""
    per = packed.groupBy("capacity_tokens").agg(F.count_distinct("container_id").alias("containers"), F.sum("tokens").cast("long").alias("tokens"))
    return per.withColumn("used", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))


def capacities(spark: SparkSession, sf_dir: str) -> list[int]:
    """The capacities to be tried: a small fixed table."""
    return sorted({r[0] for r in load(spark, sf_dir, "pack_sizes").where("capacity_tokens > 0").select("capacity_tokens").distinct().collect()})


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's places in containers of every capacity."""
    return pack(document_sizes(spark, sf_dir), capacities(spark, sf_dir))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(p8_containers(spark, sf_dir))


QUERIES = {"p8_containers": p8_containers, "p8_fill": p8_fill}
ORACLE: dict[str, str] = {}

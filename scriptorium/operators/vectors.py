"""Exact vector search: cosine top-k, checks and pending work."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 4096  # queries compared in one pass over the vectors


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """NULL for vectors of different length or without direction."""
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (n > 0), dot(a, b) / n)


def top_k(vectors: DataFrame, query: list[float], k: int, id_: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """The k most similar vectors to one query; the query is a literal, nothing is shuffled but k
    rows of each partition. Ties by id."""
    sim = cosine(F.col(vec), F.array(*[F.lit(float(x)) for x in query]))
    return vectors.select(id_, sim.alias("similarity")).where("similarity is not null").orderBy(F.desc("similarity"), id_).limit(k)


def _unit(rows: pd.Series) -> np.ndarray:
    v = np.stack([np.asarray(x, "f8") for x in rows])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _nearest_of(ids: np.ndarray, queries: np.ndarray, k: int, id_: str, vec: str):
    def run(batches):
        best_s, best_i = np.full((len(ids), 0), -2.0), np.zeros((len(ids), 0), "int64")
        for pdf in batches:
            if not len(pdf):
                continue
            mine = pdf[id_].to_numpy("int64")
            sim = np.round(queries @ _unit(pdf[vec]).T, 9)
            sim[ids[:, None] == mine[None, :]] = -2
            s, i = np.concatenate([best_s, sim], 1), np.concatenate([best_i, np.broadcast_to(mine, sim.shape)], 1)
            top = np.lexsort((i, -s), axis=1)[:, :k]
            best_s, best_i = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
        at = best_s > -2
        yield pd.DataFrame({id_: np.repeat(ids, best_s.shape[1])[at.ravel()], "neighbour": best_i[at], "similarity": best_s[at]})

    return run


def top_k_all(vectors: DataFrame, queries: DataFrame, k: int, id_: str = "vec_id", vec: str = "embedding", block: int = BLOCK) -> DataFrame:
    """The k other vectors most similar to each of a set of queries, exactly: id, neighbour, similarity,
    place (from 1). All vectors are of one length and have a direction. Ties by id.

    Queries are taken in blocks of about ``block``; a block is sent to where the vectors lie, so these
    are read once for each block and never shuffled, and each partition gives k rows a query."""
    blocks = max(1, -(-queries.count() // block))
    kind = f"{id_} long, neighbour long, similarity double"
    best = None
    for b in range(blocks):
        # About ``block`` rows.
        q = queries.where(F.pmod(F.xxhash64(id_), F.lit(blocks)) == b).select(F.col(id_).cast("long").alias(id_), vec).toPandas()
        if len(q):
            got = vectors.select(F.col(id_).cast("long").alias(id_), vec).mapInPandas(_nearest_of(q[id_].to_numpy("int64"), _unit(q[vec]), k, id_, vec), kind)
            best = got if best is None else best.unionByName(got)
    if best is None:
        best = vectors.sparkSession.createDataFrame([], kind)
    w = W.partitionBy(id_).orderBy(F.desc("similarity"), "neighbour")
    return best.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def with_rows(nearest: DataFrame, rows: DataFrame, id_: str) -> DataFrame:
    """Neighbours with the columns of their own rows (such as a term); those without a row drop out."""
    return nearest.join(rows.withColumnRenamed(id_, "neighbour"), "neighbour")


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items that have no vector yet."""
    return items.join(done.select(key), key, "left_anti")


def wrong_length(vectors: DataFrame, dim: int, id_: str, vec: str) -> DataFrame:
    return vectors.where(F.col(vec).isNull() | (F.size(vec) != dim)).select(id_, F.coalesce(F.size(vec), F.lit(0)).alias("length"))

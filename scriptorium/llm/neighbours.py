"""The k most similar vectors of every vector, by cross-polytope hashing.

Unit vectors are rotated by three rounds of random signs and a fast Hadamard transform and assigned
to the nearest signed axis. Several tables with other rotations are kept; in each a vector lies in
the bucket of its nearest axis and in those of the next best probes. All vectors of a bucket are
compared exactly in blocks, and the best k over all buckets are kept. The number of buckets follows
the number of vectors, so a bucket holds a few hundred vectors at any size. Buckets that hold more
than ``hot`` all the same, such as dense clusters, are compared whole as well: in parts, each part
with each. Of equal vectors k + 1 take part in that; they are the nearest of all further copies.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise
from ..tables import latest, load, recency

K = 5
DIM = 96
TABLES = 2  # tables up to BITS bits; one more for each MORE bits beyond, as buckets get narrower
BITS, MORE = 8, 2
PROBES = 2
BUCKET = 512  # vectors for each bucket, on average, before probes
HOT = 16_384  # a larger bucket is compared in parts of this size
SEED = 20_240
SALTS = 16


def usable(vec: Column, dim: int = DIM) -> Column:
    """Exactly ``dim`` finite numbers, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vec) == dim) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, m = x.shape
    h = 1
    while h < m:
        x = x.reshape(n, m // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        h *= 2
    return x.reshape(n, m)


def rotate(u: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-rotation of the rows of u, padded to a power of two."""
    m = 1 << max(1, (u.shape[1] - 1).bit_length())
    signs = np.random.default_rng(seed).choice(np.array([-1, 1], "f4"), (3, m))
    x = np.zeros((len(u), m), "f4")
    x[:, : u.shape[1]] = u
    for s in signs:
        x = _hadamard(x * s) / np.float32(math.sqrt(m))
    return x


def hashes(u: np.ndarray, bits: int, probes: int, seed: int) -> np.ndarray:
    """Bucket numbers of the rows of u, shape (n, probes), nearest first; -1 where there is none.

    ``bits`` are spent on as many cross-polytopes as needed; the last one uses only so many axes of
    its rotation. Further probes take the second nearest axis where it is least far behind."""
    m = 1 << max(1, (u.shape[1] - 1).bit_length())
    each = m.bit_length()
    out = np.zeros((len(u), 1), "int64")
    second, gap = [], []
    spent = 0
    while spent < bits:
        b = min(each, bits - spent)
        y = rotate(u, seed + 7919 * len(second))[:, : 1 << (b - 1)]
        y = np.concatenate([y, -y], axis=1)
        top = np.argpartition(-y, min(probes, y.shape[1] - 1), axis=1)[:, : max(probes, 1)]
        val = np.take_along_axis(y, top, 1)
        order = np.argsort(-val, axis=1, kind="stable")
        top, val = np.take_along_axis(top, order, 1), np.take_along_axis(val, order, 1)
        out = (out << b) | top[:, :1]
        second = [s << b for s in second]
        for i in range(1, top.shape[1]):
            second.append(top[:, i] - top[:, 0])
            gap.append(val[:, 0] - val[:, i])
        spent += b
    if not second or probes < 2:
        return out
    cost, delta = np.stack(gap, 1), np.stack(second, 1)
    pick = np.argsort(cost, axis=1, kind="stable")[:, : probes - 1]
    return np.concatenate([out, out + np.take_along_axis(delta, pick, 1)], axis=1)


def _pack(v: np.ndarray) -> list[bytes]:
    """Unit vectors as 16-bit numbers scaled by their largest entry; products are exact to 1e-5."""
    q = np.rint(v / np.abs(v).max(axis=1, keepdims=True) * 32767).astype("<i2")
    return [r.tobytes() for r in q]


def _unpack(rows: pd.Series, dim: int) -> np.ndarray:
    q = np.frombuffer(b"".join(rows), "<i2").reshape(len(rows), dim).astype("f4")
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def pack(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """id, vec (usable) to id, packed."""

    def run(batches):
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf["vec"].to_numpy()).astype("f8")
                yield pd.DataFrame({"id": pdf["id"], "packed": _pack(v / np.linalg.norm(v, axis=1, keepdims=True))})

    return vectors.select("id", "vec").mapInPandas(run, "id long, packed binary")


def _assign(packed: DataFrame, dim: int, bits: int, tables: int, probes: int, seed: int, with_vec: bool) -> DataFrame:
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            u = _unpack(pdf["packed"], dim)
            for t in range(tables):
                b = hashes(u, bits, probes, seed + 1_000 * t)
                for p in range(b.shape[1]):
                    out = {"bucket": (b[:, p] * tables + t)}
                    if with_vec:
                        out |= {"id": pdf["id"], "packed": pdf["packed"]}
                    yield pd.DataFrame(out)

    return packed.mapInPandas(run, "bucket long" + (", id long, packed binary" if with_vec else ""))


def _best(k: int, dim: int, block: int = 1024):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id")
        ids, u = pdf["id"].to_numpy(), _unpack(pdf["packed"], dim)
        n, kk = len(ids), min(k, len(ids) - 1)
        qs, ns, ss = [], [], []
        for i in range(0, n if kk > 0 else 0, block):
            s = u[i : i + block] @ u.T
            rows = np.arange(len(s))
            s[rows, i + rows] = -2
            top = np.argpartition(s, n - kk, axis=1)[:, n - kk :]
            qs.append(np.repeat(ids[i : i + block], kk))
            ns.append(ids[top].ravel())
            ss.append(np.take_along_axis(s, top, 1).ravel())
        if not qs:
            return pd.DataFrame({"id": [], "neighbour": [], "sim": []}).astype({"id": "int64", "neighbour": "int64", "sim": "float32"})
        return pd.DataFrame({"id": np.concatenate(qs), "neighbour": np.concatenate(ns), "sim": np.concatenate(ss)})

    return run


def _across(k: int, dim: int, block: int = 1024):
    """The best k of each row of part lo in part hi and the other way round; within the part if they are the same."""
    within = _best(k, dim, block)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or pdf["lo"].iloc[0] == pdf["hi"].iloc[0]:
            return within(pdf[["id", "packed"]])
        first = (pdf["part"] == pdf["lo"]).to_numpy()
        sides = [(x["id"].to_numpy(), _unpack(x["packed"], dim)) if len(x) else None for x in (pdf[first], pdf[~first])]
        if None in sides:
            return within(pdf[["id", "packed"]].head(0))
        out = []
        for (ids, u), (others, v) in (sides, sides[::-1]):
            kk = min(k, len(others))
            for i in range(0, len(ids), block):
                s = u[i : i + block] @ v.T
                top = np.argpartition(s, len(others) - kk, axis=1)[:, len(others) - kk :] if kk < len(others) else np.tile(np.arange(kk), (len(s), 1))
                out.append(pd.DataFrame({"id": np.repeat(ids[i : i + block], kk), "neighbour": others[top].ravel(), "sim": np.take_along_axis(s, top, 1).ravel()}))
        return pd.concat(out)

    return run


def _compare_hot(rows: DataFrame, k: int, dim: int, hot: int) -> DataFrame:
    """id, neighbour, sim within each bucket of rows (bucket, id, packed), however large it is."""
    nth = F.row_number().over(W.partitionBy("bucket", "packed").orderBy("id"))
    some = materialise(rows.withColumn("nth", nth).where(F.col("nth") <= k + 1))
    # The rest of more than k + 1 copies: the first k of them are as near as any.
    first = some.where(F.col("nth") <= k).select(F.col("bucket").alias("b"), F.col("packed").alias("v"), F.col("id").alias("neighbour"))
    full = some.where(F.col("nth") == k + 1).select(F.col("bucket").alias("b"), F.col("packed").alias("v"), F.col("id").alias("last"))
    near = first.join(full, ["b", "v"]).groupBy("b", "v").agg(F.max("last").alias("last"), F.collect_list("neighbour").alias("near"))
    near = near.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rest = rows.withColumn("s0", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(near, F.expr("bucket = b and packed = v and s0 = s and id > last"))
    copies = rest.select("id", F.explode("near").alias("neighbour"), F.lit(1.0).cast("float").alias("sim"))
    sizes = some.groupBy("bucket").agg(F.ceil(F.count("*") / hot).cast("int").alias("parts"))
    cut = some.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("bucket", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "id", "packed")
    return met.groupBy("bucket", "lo", "hi").applyInPandas(_across(k, dim), "id long, neighbour long, sim float").unionByName(copies)


def knn(packed: DataFrame, n: int, *, k: int = K, dim: int = DIM, tables: int | None = None, probes: int = PROBES, hot: int = HOT, bucket: int = BUCKET, seed: int = SEED) -> DataFrame:
    """packed: id (unique), packed; n: about how many. Returns id, neighbour, sim, rank (1 to k).

    Approximate: the share of true neighbours found is measured in the tests (0.9 at least). Equal
    similarities are ranked by the neighbour's id. Fewer than k others: as many as there are. The
    empty table gives none.
    """
    bits = max(1, int(math.log2(max(2, n / bucket))))
    if tables is None:
        tables = TABLES + max(0, bits - BITS + MORE - 1) // MORE
    sizes = _assign(packed, dim, bits, tables, probes, seed, False).groupBy("bucket").agg(F.count("*").alias("_n"))
    big = sizes.where(F.col("_n") > hot)
    rows = _assign(packed, dim, bits, tables, probes, seed, True)
    hot_rows = None
    if not big.isEmpty():
        # At most entries / hot buckets are hot.
        big = big.select("bucket")
        rows, hot_rows = rows.join(big, "bucket", "left_anti"), rows.join(big, "bucket")
    near = rows.groupBy("bucket").applyInPandas(_best(k, dim), "id long, neighbour long, sim float")
    if hot_rows is not None:
        near = near.unionByName(_compare_hot(hot_rows, k, dim, hot))
    best = near.repartition(F.col("id")).groupBy("id", "neighbour").agg(F.max("sim").alias("sim"))
    w = W.partitionBy("id").orderBy(F.col("sim").desc(), F.col("neighbour"))
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pairs(nearest: DataFrame) -> DataFrame:
    """Pairs a < b of which one is among the nearest of the other."""
    return nearest.select(F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b")).distinct()


def current_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable current vectors, packed before they are shuffled."""
    raw = load(spark, sf_dir, "glossary_embeddings").select(F.col("glossary_id").alias("id"), recency("glossary_embeddings").alias("ts"), F.when(usable(F.col("embedding")), F.col("embedding")).alias("vec"))

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            good = pdf["vec"].notna()
            packed = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
            if good.any():
                v = np.stack(pdf["vec"][good].to_numpy()).astype("f8")
                packed[good] = _pack(v / np.linalg.norm(v, axis=1, keepdims=True))
            yield pd.DataFrame({"id": pdf["id"], "ts": pdf["ts"], "packed": packed})

    rows = raw.where("id is not null").mapInPandas(run, "id long, ts long, packed binary")
    return latest(rows, ["id"], F.col("ts"), ["id", "packed"]).where("packed is not null")


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn(current_vectors(spark, sf_dir), load(spark, sf_dir, "glossary_embeddings").count())


def p5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every usable vector."""
    return _nearest(spark, sf_dir).select(F.col("id").alias("glossary_id"), F.col("neighbour").alias("neighbour_id"), "rank", F.round(F.col("sim").cast("double"), 4).alias("cosine"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(_nearest(spark, sf_dir)).select(F.col("a").alias("glossary_id_a"), F.col("b").alias("glossary_id_b"))


QUERIES = {"p5_neighbours": p5_neighbours, "p5_found": p5_found}
ORACLE: dict[str, str] = {}

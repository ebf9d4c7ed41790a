import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import neighbours as N


def exact(u, k):
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, axis=1)[:, :k]


def frame(spark, v):
    return N.pack(spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, vec array<float>"))


@pytest.mark.parametrize("hot,bucket", [(16_384, 512), (200, 256)])
def test_recall(spark, hot, bucket):
    r = np.random.default_rng(5)
    c = r.normal(size=(300, 96))
    v = (np.repeat(c, 10, axis=0) + 0.25 * r.normal(size=(3000, 96))) * r.uniform(0.3, 3, (3000, 1))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = exact(u, 5)
    got = {}
    for x in N.knn(frame(spark, v), 3000, hot=hot, bucket=bucket).collect():
        got.setdefault(x.id, set()).add(x.neighbour)
        assert abs(x.sim - u[x.id] @ u[x.neighbour]) < 2e-5
    recall = np.mean([len(got.get(i, set()) & set(w)) / 5 for i, w in enumerate(want)])
    assert recall >= 0.9


def test_copies_split_by_id(spark):
    v = np.ones((900, 96))
    got = N.knn(frame(spark, v), 900, hot=100).groupBy("id").count().collect()
    assert len(got) == 900 and {x["count"] for x in got} == {5}


def test_small_and_unusable(spark):
    rows = [(1, [1.0] * 96), (2, [0.5] * 96), (3, [0.0] * 96), (4, [1.0] * 95), (5, None), (6, []), (7, [float("nan")] + [1.0] * 95), (8, [None] + [1.0] * 95), (9, [float("inf")] + [1.0] * 95)]
    df = spark.createDataFrame(rows, "id long, vec array<float>").where(N.usable(F.col("vec")))
    assert sorted(r.id for r in df.collect()) == [1, 2]
    assert sorted((r.id, r.neighbour, r.rank) for r in N.knn(N.pack(df), 2).collect()) == [(1, 2, 1), (2, 1, 1)]
    assert N.knn(N.pack(df.limit(0)), 0).count() == 0
    assert N.pairs(N.knn(N.pack(df), 2)).count() == 1


def test_recall_on_table(spark):
    sf = "/root/testdata/sf0.01"
    pdf = N.current_vectors(spark, sf).toPandas()
    u = N._unpack(pdf["packed"], 96)
    ids = pdf["id"].to_numpy()
    want = {tuple(sorted((ids[i], ids[j]))) for i, row in enumerate(exact(u, 5)) for j in row}
    got = {(r[0], r[1]) for r in N.p5_found(spark, sf).collect()}
    assert len(want & got) / len(want) >= 0.9 and len(want & got) / len(got) >= 0.9


@pytest.mark.parametrize("cosine", [0.999, 0.9])
def test_dense_cluster_larger_than_hot(spark, cosine):
    r = np.random.default_rng(7)
    c = r.normal(size=96)
    v = c / np.linalg.norm(c) + np.sqrt(1 / cosine - 1) * r.normal(size=(3000, 96)) / np.sqrt(96)
    v = np.concatenate([v, np.repeat(v[:2], 12, axis=0), r.normal(size=(1000, 96))])
    u = N._unpack(pd.Series(N._pack(v / np.linalg.norm(v, axis=1, keepdims=True))), 96)
    got = {}
    for x in N.knn(frame(spark, v), len(v), hot=300).collect():
        got.setdefault(x.id, set()).add(x.neighbour)
    want = exact(u, 5)
    assert np.mean([len(got[i] & set(want[i])) / 5 for i in range(2, 3000)]) >= 0.95
    for i in range(2):
        copies = [i, *range(3000 + 12 * i, 3012 + 12 * i)]
        assert all(got[j] <= set(copies) and len(got[j]) == 5 for j in copies)


def test_recall_holds_as_buckets_get_narrower(spark):
    """As many bits as a much larger collection has: more tables make up for it."""
    v = N.current_vectors(spark, "/root/testdata/sf0.1")
    p = v.toPandas()
    ids, u = p["id"].to_numpy(), N._unpack(p["packed"], N.DIM)
    q = np.flatnonzero(ids % 50 == 0)
    s = u[q] @ u.T
    s[np.arange(len(q)), q] = -2
    true = dict(zip(ids[q].tolist(), (set(ids[t].tolist()) for t in np.argpartition(-s, 5, axis=1)[:, :5])))
    got = {}
    for r in N.knn(v, len(ids), bucket=16).where("id % 50 = 0").collect():
        got.setdefault(r.id, set()).add(r.neighbour)
    assert np.mean([len(true[k] & got.get(k, set())) / 5 for k in true]) >= 0.95

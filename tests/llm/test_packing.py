import random

import pytest

from scriptorium.llm import packing as P


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, tokens long")


def check(rows, cap, out):
    by, used = {}, {}
    for r in out:
        if r.capacity_tokens == cap:
            by.setdefault(r.doc_id, []).append((r.piece, r.tokens))
            used[r.container_id] = used.get(r.container_id, 0) + r.tokens
    assert max(used.values()) <= cap
    for d, _, t in rows:
        got = sorted(by[d])
        assert sum(x for _, x in got) == t and [p for p, _ in got] == list(range(len(got)))
        assert len(got) == 1 if t <= cap else all(x == cap for _, x in got[:-1])
    return used


@pytest.mark.parametrize("partition", [10**9, 3000])
def test_pack(spark, partition):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "b", "b", None]), min(5000, int(r.paretovariate(1.1) * 12)) if i % 50 else 0) for i in range(600)]
    out = P.pack(frame(spark, rows), [64, 512], partition_tokens=partition, window=4).collect()
    for cap in (64, 512):
        used = check(rows, cap, out)
        if partition > 3000:
            assert sum(used.values()) / (cap * len(used)) > 0.97


def test_edges(spark):
    assert P.pack(frame(spark, []), [8]).count() == 0
    out = P.pack(frame(spark, [(1, None, 0)]), [8]).collect()
    assert [(r.doc_id, r.piece, r.tokens) for r in out] == [(1, 0, 0)]
    out = P.pack(frame(spark, [(1, "a", 16), (1, "a", 16), (2, "a", 17)]), [8]).collect()
    assert sorted(r.tokens for r in out) == [1] + [8] * 6


def test_windows_keep_proportions():
    import numpy as np

    src = np.array(["a"] * 900 + ["b"] * 100, object)
    got = P.drr(np.full(1000, 10), src, {"a": 0.9, "b": 0.1}, {}, 500.0)
    assert sorted(i for w in got for i in w) == list(range(1000))
    for w in got[:-1]:
        assert abs((src[w] == "b").mean() - 0.1) < 0.03
    assert (src[P.drr(np.full(1000, 10), src, {"a": 0.9, "b": 0.1}, {"b": 100.0}, 500.0)[0]] == "b").sum() >= 14


def test_absent_source_is_credited(spark):
    held = spark.createDataFrame([("a", 0, 100), ("a", 1, 100), ("b", 2, 40), ("a", 2, 60)], "source string, part int, held long")
    share = spark.createDataFrame([("a", 0.8), ("b", 0.2)], "source string, share double")
    got = {(r.source, r.part): round(r.deficit, 6) for r in P.carried(held, share).collect()}
    assert got == {("a", 0): 0.0, ("a", 1): -20.0, ("a", 2): -40.0, ("b", 2): 40.0}


def test_fill_near_the_bound(spark):
    r = random.Random(3)
    rows = [(i, r.choice("abc"), r.randint(1, 90)) for i in range(4000)]
    out = P.pack(frame(spark, rows), [100, 1000], window=64)
    total = sum(t for _, _, t in rows)
    for f in P.fill(out).collect():
        assert f.tokens == total and f.containers >= -(-total // f.capacity_tokens)
        assert f.containers <= 1.02 * total / f.capacity_tokens + 1

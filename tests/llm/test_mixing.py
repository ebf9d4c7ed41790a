import random

from scriptorium.llm import mixing as M

TARGETS = [("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 2), ("none", 0.1, 3), ("bad", None, 1)]


def data(spark, n=900):
    r = random.Random(4)
    rows = [(i, "a" if i % 3 == 0 else ("b" if i % 9 == 1 else ("c" if i % 3 == 1 else "other")), r.randrange(0, 60)) for i in range(n)] + [(5000, None, 9), (5001, "bad", 9)]
    return spark.createDataFrame(rows, "doc_id long, source string, tokens long"), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")


def test_shares_and_caps(spark):
    sizes, t = data(spark)
    have = {r.source: r for r in M.per_source(sizes, t).collect()}
    # No source runs out below this total.
    budget = min(r.have * r.max_repeats / r.target_share for r in have.values())
    for slices in (10**6, 50):
        m = M.mix(sizes, t, budget, slice_rows=slices).collect()
        assert [r.position for r in sorted(m, key=lambda r: r.virtual_time)] == list(range(1, len(m) + 1)) or sorted(r.position for r in m) == list(range(1, len(m) + 1))
        total = sum(r.tokens for r in m)
        assert budget - 60 <= total <= budget
        share = {s: sum(r.tokens for r in m if r.source == s) / total for s in "abc"}
        assert all(abs(share[s] - x) < 0.01 for s, x in (("a", 0.5), ("b", 0.3), ("c", 0.2)))
        uses = {}
        for r in m:
            uses[(r.source, r.doc_id)] = uses.get((r.source, r.doc_id), 0) + 1
        cap = {"a": 1, "b": 4, "c": 2}
        assert all(n <= cap[s] for (s, _), n in uses.items())
        # Every prefix has the proportions.
        half = [r for r in m if r.position <= len(m) / 2]
        assert abs(sum(r.tokens for r in half if r.source == "a") / sum(r.tokens for r in half) - 0.5) < 0.02


def test_budget_beyond_and_empty(spark):
    sizes, t = data(spark)
    m = M.mix(sizes, t, budget=1e12)
    s = {r.source: r for r in M.shares(m, t).collect()}
    assert s["b"].most_uses == 4 and s["a"].most_uses == 1 and s["none"].uses == 0 and s["bad"].actual_share == 0
    assert M.mix(sizes.limit(0), t).count() == 0
    assert M.mix(sizes, t.limit(0)).count() == 0


def test_other_columns(spark):
    sizes, t = data(spark)
    more = sizes.selectExpr("*", "'x' as copy", "1.0 as target_share", "3 as slice")
    assert M.mix(more, t.selectExpr("*", "9 as tokens")).count() == M.mix(sizes, t).count()
    assert M.shares(M.mix(sizes, t), t.selectExpr("*", "9 as tokens")).count() == 5


def brute(rows, targets, budget, seed):
    """The fair order by a plain loop: the same shuffle, finish times and prefix."""
    order = []
    for s, share, most in targets:
        at = 0
        for copy in range(1, (most or 0) + 1 if share and share > 0 else 1):
            for h, d, n in sorted((h, d, n) for (d, c, h, src, n) in rows if src == s and c == copy):
                at += n
                order.append((at / share, s, d, copy, n))
    total, out = 0, []
    for v in sorted(order):
        total += v[4]
        if total > budget:
            break
        out.append(v)
    return out


def test_like_a_plain_loop(spark):
    from pyspark.sql import functions as F

    sizes, t = data(spark, 300)
    rows = [tuple(r) for r in sizes.where("tokens > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(4)))).select("doc_id", "copy", F.xxhash64("doc_id", "copy", F.lit(M.SEED)), "source", "tokens").collect()]
    all_ = M.budget_of(sizes, t)
    for budget, size in ((None, 10**6), (all_ / 3, 40), (all_ * 1.7, 40)):
        m = sorted(M.mix(sizes, t, budget, slice_rows=size).collect(), key=lambda r: r.position)
        want = brute(rows, TARGETS, all_ if budget is None else budget, M.SEED)
        assert [(r.source, r.doc_id, r.copy, r.tokens) for r in m] == [v[1:] for v in want]


def test_default_total_follows_the_records(spark):
    """A source of a few records that is soon used up falls short; it doesn't hold the others back."""
    def of(n):
        return spark.createDataFrame([(i, "a", 10) for i in range(n)] + [(10**6 + i, "b", 10) for i in range(3)], "doc_id long, source string, tokens long")

    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    small, large = (M.mix(of(n), t) for n in (200, 2000))
    assert 9 < large.count() / small.count() < 11
    s = {r.source: r for r in M.shares(large, t).collect()}
    assert s["b"].uses == 6 and abs(s["b"].shortfall - (0.5 - s["b"].actual_share)) < 1e-9 and s["a"].shortfall == 0

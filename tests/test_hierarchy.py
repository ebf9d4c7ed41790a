import random

import pytest

from scriptorium.operators import hierarchy as H


def brute(rows):
    scope = {n: s for n, p, s in rows}
    par = {n: (p if p in scope and scope[p] == s else None) for n, p, s in rows}
    lost = {n for n, p, s in rows if p is not None and par[n] is None}
    out = {}
    for n in par:
        seen, at = [n], n
        while par[at] is not None and par[at] not in seen:
            at = par[at]
            seen.append(at)
        if par[at] is None:
            out[n] = ("lost" if at in lost else "root", len(seen), at, seen[::-1], n in lost)
        else:
            out[n] = ("cycle" if par[at] == n or (par[at] in seen and seen.index(par[at]) == 0) else "below_cycle", None, None, None, False)
    return out


@pytest.mark.parametrize("seed,bits,last", [(1, 2, 5), (2, 3, 4), (3, 1, 10), (4, 13, 1000)])
def test_random_forests(spark, seed, bits, last):
    r = random.Random(seed)
    n = 150
    rows = []
    for i in range(n):
        p = None if r.random() < 0.08 else (r.randrange(max(1, i - 6), i + 1) if r.random() < 0.85 and i else r.randrange(n + 5))
        rows.append((i, p, 0 if r.random() < 0.97 else 1))
    df = spark.createDataFrame(rows, "node long, parent long, scope long")
    got = {x.node: (x.state, x.depth, x.root, x.path, x.own_lost) for x in H.resolve(df, paths=True, block_bits=bits, last=last).collect()}
    assert got == brute(rows)


def test_long_chain_doubling_and_loop(spark):
    n = 60
    rows = [(i * 64, (i - 1) * 64 if i else None, None) for i in range(n)] + [(10_000_001, 10_000_001, 1), (10_000_002, 10_000_001, 1)]
    df = spark.createDataFrame(rows, "node long, parent long, scope long")
    got = {x.node: x for x in H.resolve(df, paths=True, block_bits=1, last=3).collect()}
    assert got[59 * 64].depth == 60 and got[59 * 64].path == [i * 64 for i in range(60)]
    assert got[10_000_001].state == "cycle" and got[10_000_002].state == "below_cycle"
    assert H.descendants(H.resolve(df, paths=True, block_bits=1, last=3)).count() == n * (n - 1) // 2


def test_empty(spark):
    df = spark.createDataFrame([], "node long, parent long, scope long, level int")
    r = H.resolve(df)
    assert r.count() == 0 and H.problems(r, df.select("node", "level")).count() == 0

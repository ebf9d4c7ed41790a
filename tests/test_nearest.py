import random

import pytest

from scriptorium.operators.nearest import next_larger

KIND = "id long, key string, pos long, value double, asks boolean, gives boolean"


def brute(rows):
    out = {}
    for i, k, p, v, asks, _ in rows:
        if asks and p is not None and v is not None:
            later = [(q, w) for _, l, q, w, _, g in rows if l == k and g and q is not None and w is not None and q > p and w > v]
            out[i] = min(later) if later else (None, None)
    return out


@pytest.mark.parametrize("bits,share", [(20, 10**6), (3, 10**6), (1, 7)])
def test_like_brute_force(spark, bits, share):
    r = random.Random(bits)
    rows = [(i, r.choice("aab"), i * 2 - 300, float(r.randrange(40) if i % 3 else 300 - i), r.random() < 0.8, r.random() < 0.7) for i in range(300)]
    rows += [(900, "a", None, 1.0, True, True), (901, "a", 3, None, True, True), (902, "only", 3, 1.0, True, False)]
    got = {x.id: (x.found, x.larger) for x in next_larger(spark.createDataFrame(rows, KIND), block_bits=bits, share_rows=share).collect()}
    assert got == brute(rows)


def test_empty(spark):
    assert next_larger(spark.createDataFrame([], KIND)).count() == 0

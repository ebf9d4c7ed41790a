"""For every row the first later row of its key with a larger value.

Positions are cut into blocks. In a block all rows that find an answer there are settled by one pass
with a stack. The others look for the first later block of their key whose maximum is larger, and
then for the row in that block. A key of any size is thus spread over as many blocks as its
positions need; where many rows ask one block, they are spread over shares of it.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

BLOCK_BITS = 13  # 8,192 neighbouring positions make a block
SHARE_ROWS = 100_000  # rows that ask of one block of maxima or rows in one task, about

def key_of(*columns: str) -> Column:
    """Several columns as one key; NULL is a key."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])


def _in_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows that ask with what they find in the block; and, with no id, the maximum of every key."""
    pdf = pdf.sort_values(["key", "pos"], kind="stable", ascending=False)
    out, last = [], None
    values: list[float] = []  # negated, ascending: the nearest row of each height
    places: list[int] = []
    for i, key, pos, value, asks, gives in zip(pdf["id"], pdf["key"], pdf["pos"], pdf["value"], pdf["asks"], pdf["gives"]):
        if key != last:
            values, places, last = [], [], key
        if asks:
            n = bisect_left(values, -value)
            while n and places[n - 1] == pos:
                n -= 1
            out.append((i, key, pos, value, places[n - 1] if n else None, -values[n - 1] if n else None))
        if gives:
            while values and -values[-1] <= value:
                values.pop(), places.pop()
            values.append(-value), places.append(pos)
    tops = pdf[pdf["gives"]].groupby("key", sort=False)["value"].max()
    block = pdf["block"].iat[0]
    out += [(None, k, block, v, None, None) for k, v in tops.items()]
    f = pd.DataFrame(out, columns=["id", "key", "pos", "value", "found", "larger"])
    return f.astype({"id": "Int64", "key": object, "pos": "int64", "value": "float64", "found": "Int64", "larger": "float64"})


def _first_block(asks: pd.DataFrame, blocks: np.ndarray, tops: np.ndarray) -> pd.DataFrame:
    """The first block after the asking one whose maximum is larger, by halving over range maxima."""
    v = asks["value"].to_numpy()
    table = [tops]
    while 2 * (1 << (len(table) - 1)) <= len(blocks):
        h = 1 << (len(table) - 1)
        table.append(np.maximum(table[-1][:-h], table[-1][h:]))
    at = np.searchsorted(blocks, asks["block"].to_numpy(), side="right")
    for k in range(len(table) - 1, -1, -1):
        fits = at + (1 << k) <= len(blocks)
        low = fits & (table[k][np.where(fits, at, 0)] <= v)
        at = at + np.where(low, 1 << k, 0)
    ok = at < len(blocks)
    return asks[ok].assign(goal=blocks[at[ok]])


def _in_goal(asks: pd.DataFrame, places: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    high = np.maximum.accumulate(values)
    at = np.searchsorted(high, asks["value"].to_numpy(), side="right")
    return asks.assign(found=places[at], larger=values[at])


def _by_key(step, keys: list[str], x: str, y: str, kinds: dict[str, object]):
    """Many keys in one task: those that ask, each with its rows in the order of x."""

    def run(asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asks) and len(rows):
            rows = rows.sort_values([x, y]).drop_duplicates([*keys, x], keep="last")
            held = {k: (g[x].to_numpy(), g[y].to_numpy()) for k, g in rows.groupby(keys, sort=False)}
            out = [step(g, *held[k]) for k, g in asks.groupby(keys, sort=False) if k in held]
        return (pd.concat(out) if out else pd.DataFrame({c: [] for c in kinds}))[list(kinds)].astype(kinds)

    return run


def next_larger(rows: DataFrame, *, block_bits: int = BLOCK_BITS, share_rows: int = SHARE_ROWS) -> DataFrame:
    """rows: id bigint, key string, pos bigint, value double, asks boolean, gives boolean.

    For every row that asks: id, key, found and larger, the position and value of the first giving
    row of its key at a later position with a larger value, NULL where there is none. Rows at the
    same position aren't later. Rows with a NULL position or value neither ask nor give.
    """
    r = rows.where("pos is not null and value is not null").select("id", "key", F.col("pos").cast("long").alias("pos"), F.col("value").cast("double").alias("value"), "asks", "gives")
    r = r.withColumn("block", F.shiftright("pos", block_bits))
    both = materialise(r.groupBy("block").applyInPandas(_in_block, "id long, key string, pos long, value double, found long, larger double"))
    near, tops = both.where("id is not null"), both.where("id is null").select("key", "pos", "value").toDF("key", "block", "top")
    settled = near.where("found is not null").select("id", "key", "found", "larger")
    none = near.where("found is null").select("id", "key", "found", "larger")
    # Keys that lie in several blocks; a row of one that holds nothing larger anywhere asks no more.
    ends = tops.groupBy(F.col("key").alias("k")).agg(F.max("block").alias("last"), F.max("top").alias("most"), F.count("*").alias("blocks")).where("blocks > 1")
    asked = near.where("found is null").withColumn("block", F.shiftright("pos", block_bits))
    far = materialise(asked.join(ends, F.expr("key = k and last > block and most > value"), "left_semi").select("id", "key", "block", "value"))
    n = far.count()
    if not n:
        return settled.unionByName(none)
    shares = max(1, n // share_rows)
    slots = max(8, n // 20_000)
    share, every = F.pmod(F.xxhash64("id"), F.lit(shares)).cast("long"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))
    slot = lambda *by: F.pmod(F.xxhash64(*by, "share"), F.lit(slots))
    wide = tops.join(far.select(F.col("key").alias("k")).distinct(), F.expr("key = k"), "left_semi").withColumn("share", every)
    first = _by_key(_first_block, ["key"], "block", "top", {"id": "int64", "key": object, "value": "float64", "goal": "int64"})
    asks = far.withColumn("share", share).withColumn("slot", slot("key"))
    goals = materialise(asks.groupBy("slot").cogroup(wide.withColumn("slot", slot("key")).groupBy("slot")).applyInPandas(first, "id long, key string, value double, goal long"))
    held = r.where("gives").join(goals.select(F.col("key").alias("k"), F.col("goal").alias("g")).distinct(), F.expr("key = k and block = g"), "left_semi")
    held = held.select("key", F.col("block").alias("goal"), "pos", "value").withColumn("share", every)
    last = _by_key(_in_goal, ["key", "goal"], "pos", "value", {"id": "int64", "key": object, "found": "int64", "larger": "float64"})
    asks = goals.withColumn("share", share).withColumn("slot", slot("key", "goal"))
    got = asks.groupBy("slot").cogroup(held.withColumn("slot", slot("key", "goal")).groupBy("slot")).applyInPandas(last, "id long, key string, found long, larger double")
    return settled.unionByName(got).unionByName(none.join(goals.select(F.col("id").alias("i"), F.col("key").alias("k")), F.expr("id = i and key = k"), "left_anti"))

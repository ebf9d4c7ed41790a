"""Parent-child links of unknown depth: depth, root, path, descendants and cycles.

The rows are cut into blocks of neighbouring ids. In every block the chains of parents are
contracted by pointer jumping to fragments, whose tops have their parent in another block or none.
The tops and the fragments their parents lie in form a smaller forest (the quotient), which is
solved in the same way with larger blocks; once it is small enough, in one block, and where
contraction doesn't shrink it, by doubling over joins. The answers of the tops are then carried
back into their fragments. No step is longer than the logarithm of the longest chain, no group
larger than a block, and a tree or book of any size is spread over as many blocks as its rows need.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

BLOCK_BITS = 13  # 8,192 neighbouring ids make a block
LAST = 200_000  # so many nodes of a quotient are solved in one task

ROOT, LOST, CYCLE, BELOW = 0, 1, 2, 3
_OPEN = -1


def _jump(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Follow ``nxt`` (own index: the end) to the end. Returns where each node ends and a mask of
    nodes that never end; for those the place is a node of their cycle."""
    at = nxt.copy()
    for _ in range(max(1, math.ceil(math.log2(max(2, len(nxt)))) + 1)):
        at = at[at]
    return at, nxt[at] != at


def _contract(paths: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, par = pdf["id"].to_numpy(), pdf["parent"].to_numpy()
        has = pdf["has_parent"].to_numpy()
        order = np.argsort(ids, kind="stable")
        pos = np.searchsorted(ids[order], par)
        pos = np.minimum(pos, len(ids) - 1)
        cand = order[pos]
        local = has & (ids[cand] == par)
        loop = local & (cand == np.arange(len(ids)))
        here = np.arange(len(ids))
        nxt = np.where(local & ~loop, cand, here)
        top, endless = _jump(nxt)
        # A node that is its own parent is a cycle of one.
        on = np.zeros(len(ids), bool)
        on[top[endless]] = True
        on |= loop
        stuck = endless | loop[top]
        state = np.where(on, CYCLE, np.where(stuck, BELOW, _OPEN))
        hop = pdf["hop"].to_numpy()
        depth = np.where(stuck, 0, hop).astype("int64")
        at, d = np.where(stuck, here, nxt), depth.copy()
        d[at == here] = 0
        for _ in range(max(1, math.ceil(math.log2(max(2, len(ids)))) + 1)):
            d, at = d + d[at], at[at]
        out = pd.DataFrame({"id": ids, "top": ids[top], "dist": d, "state": state.astype("int32")})
        out["out"] = np.where(local[top], 0, par[top])
        out["out_has"] = has[top] & ~local[top]
        out["out_hop"] = hop[top]
        if paths:
            seg = pdf["seg"].to_numpy()
            steps = np.zeros(len(ids), "int64")
            at = np.where(stuck, here, nxt)
            one = (at != here).astype("int64")
            for _ in range(max(1, math.ceil(math.log2(max(2, len(ids)))) + 1)):
                one, at = one + one[at], at[at]
            steps = one
            way: list = [None] * len(ids)
            for i in np.argsort(steps, kind="stable"):
                way[i] = [] if stuck[i] or nxt[i] == i else [*way[nxt[i]], *seg[i]]
            out["way"] = way
            out["out_seg"] = [seg[t] for t in top]
        return out

    return run


def _mark(cols: list[str]):
    def run(nodes: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        """Nodes of a fragment on the way from an entry of the cycle up to the fragment's top."""
        if nodes.empty:
            return nodes[cols]
        at = {int(x): i for i, x in enumerate(nodes["id"])}
        par, state = nodes["parent"].to_numpy(), nodes["state"].to_numpy().copy()
        state[:] = BELOW
        for m in marks["entry"]:
            i = at.get(int(m))
            while i is not None and state[i] != CYCLE:
                state[i] = CYCLE
                i = at.get(int(par[i])) if nodes["id"].iat[i] != nodes["top"].iat[i] else None
        return nodes.assign(state=state)[cols]

    return run


def _double(nodes: DataFrame) -> DataFrame:
    """Pointer doubling over joins for a forest that blocks don't shrink."""
    cur = materialise(
        nodes.alias("a")
        .join(nodes.select(F.col("id").alias("pid")).alias("p"), F.expr("a.has_parent and a.parent = p.pid"), "left")
        .select(
            "id",
            F.coalesce("pid", "id").alias("at"),
            F.when(F.col("pid").isNotNull(), F.col("hop")).otherwise(F.lit(0).cast("long")).alias("dist"),
            F.when(F.col("pid").isNotNull(), _OPEN).when(F.col("has_parent"), LOST).otherwise(ROOT).alias("state"),
            F.when(F.col("pid").isNotNull(), F.col("seg")).otherwise(F.expr("cast(array() as array<bigint>)")).alias("way"),
        )
    )
    n = cur.count()
    for _ in range(math.ceil(math.log2(max(2, n))) + 1):
        open_ = cur.where(f"state = {_OPEN}")
        if open_.isEmpty():
            break
        done = cur.where(f"state <> {_OPEN}")
        far = cur.select(F.col("id").alias("fid"), F.col("at").alias("fat"), F.col("dist").alias("fdist"), F.col("state").alias("fstate"), F.col("way").alias("fway"))
        # A pointer at a finished node takes over its end.
        stepped = open_.join(far, F.col("at") == F.col("fid")).select("id", F.col("fat").alias("at"), (F.col("dist") + F.col("fdist")).alias("dist"), F.col("fstate").alias("state"), F.concat("fway", "way").alias("way"))
        cur = materialise(done.unionByName(stepped))
    images = cur.where(f"state = {_OPEN}").select(F.col("at").alias("cid")).distinct()
    return cur.join(images, F.col("id") == F.col("cid"), "left").select(
        "id", F.col("at").alias("root"), "dist", F.when(F.col("state") != _OPEN, F.col("state")).when(F.col("cid").isNotNull(), CYCLE).otherwise(BELOW).cast("int").alias("state"), "way"
    )


def _solve(nodes: DataFrame, bits: int, paths: bool, last: int, before: int | None) -> DataFrame:
    """nodes: id, parent, has_parent, hop, seg. Returns id, root, dist (from root), state, way."""
    n = nodes.count()
    if before is not None and n > last and n > 0.8 * before:
        return _double(nodes)
    shift = 62 if n <= last and before is not None else bits
    nodes = nodes.withColumn("block", F.shiftright("id", shift))
    kind = "id long, top long, dist long, state int, out long, out_has boolean, out_hop long" + (", way array<bigint>, out_seg array<bigint>" if paths else "")
    cut = materialise(nodes.groupBy("block").applyInPandas(_contract(paths), kind))
    empty = F.expr("cast(array() as array<bigint>)")
    if not paths:
        cut = cut.withColumn("way", empty).withColumn("out_seg", empty)
    tops = cut.where(f"state = {_OPEN} and id = top")
    exits = tops.where("out_has").select(F.col("id").alias("xid"), "out", "out_hop", "out_seg")
    # Where the parent of each top lies; none: the link is lost.
    met = materialise(
        exits.join(cut.select(F.col("id").alias("pid"), F.col("top").alias("ptop"), F.col("dist").alias("pdist"), F.col("state").alias("pstate"), F.col("way").alias("pway")), F.col("out") == F.col("pid"), "left")
    )
    ends = tops.where("not out_has").select("id", F.lit(ROOT).alias("state")).unionByName(met.where("pid is null").select(F.col("xid").alias("id"), F.lit(LOST).alias("state")))
    ends = ends.unionByName(met.where(f"pid is not null and pstate <> {_OPEN}").select(F.col("xid").alias("id"), F.lit(BELOW).alias("state")))
    inner = met.where(f"pstate = {_OPEN}")
    solved = ends.select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("dist"), F.col("state").cast("int").alias("state"), empty.alias("way"))
    hot = None
    if not inner.isEmpty():
        up = inner.select(F.col("xid").alias("id"), F.col("ptop").alias("parent"), F.lit(True).alias("has_parent"), (F.col("out_hop") + F.col("pdist")).alias("hop"), F.concat("pway", "out_seg").alias("seg"))
        base = ends.select("id", F.lit(0).cast("long").alias("parent"), F.lit(False).alias("has_parent"), F.lit(0).cast("long").alias("hop"), empty.alias("seg"))
        got = _solve(up.unionByName(base), bits + 4, paths, last, n).alias("g")
        # A top whose chain ends at a top that is lost or below a cycle shares that end.
        e = ends.select(F.col("id").alias("eid"), F.col("state").alias("estate"))
        solved = materialise(
            got.join(e, F.expr("g.root = eid and g.state = 0"), "left").select("id", "root", "dist", F.coalesce("estate", "state").cast("int").alias("state"), "way")
        )
        hot = solved.where(f"state = {CYCLE}")
    s = solved.select(F.col("id").alias("sid"), F.col("root").alias("sroot"), F.col("dist").alias("sdist"), F.col("state").alias("sstate"), F.col("way").alias("sway"))
    full = cut.join(s, F.expr(f"top = sid and state = {_OPEN}"), "left").select(
        "id", "top", F.coalesce("sroot", "top").alias("root"), (F.col("dist") + F.coalesce("sdist", F.lit(0).cast("long"))).alias("dist"), F.coalesce("sstate", "state").alias("state"), F.concat(F.coalesce("sway", empty), "way").alias("way"), F.col("sid").isNotNull().alias("carried")
    )
    if hot is None or hot.isEmpty():
        return full.select("id", "root", "dist", "state", "way")
    # Of fragments whose top is on a cycle only the way from the cycle's entry to the top is on it.
    entries = inner.join(hot.select(F.col("id").alias("xid")), "xid").select(F.col("out").alias("entry"), F.shiftright("out", shift).alias("block"))
    rest = full.where(f"not (carried and state = {CYCLE})").select("id", "root", "dist", "state", "way")
    near = full.where(f"carried and state = {CYCLE}").join(nodes.select("id", "parent", "block"), "id")
    marked = near.groupBy("block").cogroup(entries.groupBy("block")).applyInPandas(_mark(["id", "root", "dist", "state", "way"]), "id long, root long, dist long, state int, way array<bigint>")
    return rest.unionByName(marked)


def resolve(links: DataFrame, *, paths: bool = False, block_bits: int = BLOCK_BITS, last: int = LAST) -> DataFrame:
    """links: node bigint (unique), parent bigint, scope bigint; a parent counts only in its scope.

    Returns one row per node: node, root (the end of its chain; of nodes on or below a cycle NULL),
    depth (1 for an end; NULL likewise), state ``root`` (the chain ends where parent is NULL),
    ``lost`` (at a node whose parent doesn't exist in its scope), ``cycle`` or ``below_cycle``,
    own_lost (the node's own parent doesn't exist) and, with ``paths``, path (node ids from the
    end down to the node). NULL scopes are one scope; rows whose node is NULL are left out.
    """
    n = links.where("node is not null").select("node", "parent", F.coalesce("scope", F.lit(-(1 << 62))).alias("scope"))
    ids = n.select(F.col("node").alias("pnode"), F.col("scope").alias("pscope"))
    checked = materialise(
        n.join(ids, F.expr("parent = pnode and scope = pscope"), "left").select("node", "scope", "parent", (F.col("parent").isNotNull() & F.col("pnode").isNull()).alias("own_lost"))
    )
    seg = F.array("node") if paths else F.expr("cast(array() as array<bigint>)")
    nodes = checked.select(F.col("node").alias("id"), F.coalesce("parent", F.lit(0).cast("long")).alias("parent"), (F.col("parent").isNotNull() & ~F.col("own_lost")).alias("has_parent"), F.lit(1).cast("long").alias("hop"), seg.alias("seg"))
    got = _solve(nodes, block_bits, paths, last, None)
    lost = checked.where("own_lost").select(F.col("node").alias("lnode"))
    out = got.join(lost, F.col("root") == F.col("lnode"), "left")
    good = F.col("state") == ROOT
    out = out.select(
        F.col("id").alias("node"),
        F.when(good, F.col("root")).alias("root"),
        F.when(good, F.col("dist") + 1).alias("depth"),
        F.when(good & F.col("lnode").isNull(), "root").when(good, "lost").when(F.col("state") == CYCLE, "cycle").otherwise("below_cycle").alias("state"),
        (good & (F.col("root") == F.col("id")) & F.col("lnode").isNotNull()).alias("own_lost"),
        *([F.when(good, F.concat(F.array("root"), "way")).alias("path")] if paths else []),
    )
    return out


def problems(resolved: DataFrame, levels: DataFrame) -> DataFrame:
    """One row (node, problem) for each broken link, loop and stored level that isn't the depth.

    levels: node, level. A NULL level contradicts nothing.
    """
    r = resolved.join(levels, "node")
    return r.select(
        "node",
        F.explode(
            F.filter(
                F.array(
                    F.when(F.col("own_lost"), "lost_parent"),
                    F.when(F.col("state").isin("cycle", "below_cycle"), F.col("state")),
                    F.when((F.col("state") == "root") & (F.col("level") != F.col("depth")), "level"),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("problem"),
    )


def descendants(resolved: DataFrame) -> DataFrame:
    """All (ancestor, descendant, distance) of chains that end; needs ``paths``."""
    return resolved.where("path is not null").select(F.col("node").alias("descendant"), F.posexplode("path").alias("_i", "ancestor"), (F.col("depth") - 1).alias("_d")).where("_i < _d").select(
        "ancestor", "descendant", (F.col("_d") - F.col("_i")).cast("long").alias("distance")
    )

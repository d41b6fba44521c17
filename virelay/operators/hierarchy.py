"""Parent-child links of unknown depth to full paths: fragments, quotient forest, expansion."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from virelay.session import counted_cut, cut_lineage

#: Nodes that one fragment may hold, and those worth a fragment; a forest of fewer is solved in one.
FRAGMENT_NODES, LEAST_NODES = 50_000, 300
#: Values of one Arrow array.
_CHUNK = 1 << 28
_SOLVED = "frag long, node long, parent long, exit long, steps array<bigint>"


def latest_links(df: DataFrame, node: str, parent: str, version: str | None = None) -> DataFrame:
    """(node, parent): one row for each non-null node, of its latest version; among equally late ones the smallest
    non-null parent counts. A null parent, the node itself, or a parent that is no node makes a root (null)."""
    order = F.col(version) if version else F.lit(0)
    best = (
        df.where(F.col(node).isNotNull())
        .groupBy(F.col(node).cast("bigint").alias("node"))
        .agg(F.max_by(F.col(parent).cast("bigint"), F.struct(order.alias("v"), (-F.col(parent).cast("bigint")).alias("p"))).alias("parent"))
    )
    known = best.select(F.col("node").alias("parent"))
    linked = best.where(F.col("parent") != F.col("node")).join(known, "parent", "left_semi").select("node", "parent")
    return best.select("node").join(linked, "node", "left")


def _segments(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of segments, one segment after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _contract(t: pa.Table) -> pa.Table:
    """Parent chains within a fragment. ``steps`` are the loads (paths) of the nodes from behind the exit down to the node.

    ``exit`` is the first ancestor outside the fragment, null at a root. Nodes on or below a loop that lies in the fragment get null steps. All steps
    lie in one array, filled from the tops of the chains down: those of a node are a copy of its parent's and its own load.
    """
    node, load = t["node"].to_numpy(), t["load"].combine_chunks()
    has, parent = t["parent"].is_valid().to_numpy(), t["parent"].fill_null(-1).to_numpy()
    order = np.argsort(node)
    at = np.minimum(np.searchsorted(node[order], parent), len(node) - 1)
    up = np.where(has & (node[order][at] == parent), order[at], -1)
    load_at, load_n = np.asarray(load.offsets)[:-1].astype(np.int64), np.diff(np.asarray(load.offsets)).astype(np.int64)
    # pointer doubling: what lies between a node and the place its jump leads to; a jump that never ends is on a loop
    jump, top, height, size = up.copy(), np.arange(len(node)), np.ones(len(node), np.int64), load_n.copy()
    for _ in range(len(node).bit_length() + 1):
        go = np.flatnonzero(jump >= 0)
        to = jump[go]
        top[go], height[go], size[go] = top[to], height[go] + height[to], size[go] + size[to]
        jump[go] = jump[to]
    ok = jump < 0
    size[~ok] = 0
    begin = np.cumsum(size) - size
    values, loads = np.empty(int(size.sum()), np.int64), np.asarray(load.values)
    by_height = np.flatnonzero(ok)
    by_height = by_height[np.argsort(height[by_height], kind="stable")]
    for part in np.split(by_height, np.flatnonzero(np.diff(height[by_height])) + 1):
        above = np.where(up[part] >= 0, size[up[part]], 0)
        values[_segments(begin[part], above)] = values[_segments(begin[up[part]], above)]
        values[_segments(begin[part] + above, load_n[part])] = loads[_segments(load_at[part], load_n[part])]
    # lists of an Arrow array have offsets of 32 bits
    pieces = []
    for rows in np.split(np.arange(len(node)), np.searchsorted(begin, np.arange(_CHUNK, len(values), _CHUNK))):
        if len(rows):
            first, end = begin[rows[0]], begin[rows[-1]] + size[rows[-1]]
            offsets = np.append(begin[rows] - first, end - first).astype(np.int32)
            pieces.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[first:end]), mask=pa.array(~ok[rows])))
    exits = pa.array(parent[top], mask=~(ok & has[top]))
    return pa.table({"frag": t["frag"], "node": t["node"], "parent": t["parent"], "exit": exits, "steps": pa.chunked_array(pieces, pa.list_(pa.int64()))})


def _n_fragments(spark: SparkSession, n: int, fragment_nodes: int) -> int:
    """As many fragments as tasks can run at once, unless they would be tiny, and as many as their size asks for."""
    return max(1, math.ceil(n / fragment_nodes), min(spark.sparkContext.defaultParallelism, n // LEAST_NODES))


def _fragments(links: DataFrame, n: int, level: int, fragment_nodes: int) -> DataFrame:
    """``links`` with the number of their fragment, up to about ``fragment_nodes`` nodes in each.

    A node and its parent meet under the one of smaller hash, so
    a third of all links or more fall inside fragments whatever their number, and chains shrink by a fixed rate at
    each level; where more nodes than a fragment holds would meet under one parent, they are spread by hash.
    """
    count = _n_fragments(links.sparkSession, n, fragment_nodes)
    spread = F.xxhash64("node", F.lit(level))
    if count == 1:
        return links.select(F.pmod(spread, F.lit(count)).alias("frag"), "node", "parent", "load")
    # the hash of a null parent is a constant: a root meets its children under its own name only
    under = F.col("parent").isNotNull() & (F.xxhash64("parent", F.lit(level)) < spread)
    keyed = links.withColumn("meet", F.when(under, F.col("parent")).otherwise(F.col("node")))
    crowded = keyed.groupBy("meet").count().where(F.col("count") > fragment_nodes // 4).select("meet", F.lit(True).alias("crowded"))
    return (
        keyed.join(F.broadcast(crowded), "meet", "left")  # at most 4 rows for each fragment of nodes
        .withColumn("frag", F.pmod(F.when(F.col("crowded"), spread).otherwise(F.xxhash64("meet", F.lit(level))), F.lit(count)))
        .select("frag", "node", "parent", "load")
    )


def _solve(links: DataFrame, n: int, level: int, fragment_nodes: int) -> DataFrame:
    """(node, path): the loads of all nodes from the root down to the node, joined; null where the way up never ends."""
    solved = _fragments(links, n, level, fragment_nodes).groupBy("frag").applyInArrow(_contract, _SOLVED)
    if _n_fragments(links.sparkSession, n, fragment_nodes) == 1:
        return solved.select("node", F.col("steps").alias("path"))
    solved = cut_lineage(solved)
    # the quotient forest: the nodes at which chains leave their fragments, each linked to its own exit
    gates = solved.where(F.col("exit").isNotNull()).select(F.col("exit").alias("node")).distinct()
    # a gate that hangs on a loop inside its fragment is linked to itself: it stays on a loop
    lost = F.col("steps").isNull()
    quotient, m = counted_cut(solved.join(gates, "node", "left_semi").select("node", F.when(lost, F.col("node")).otherwise(F.col("exit")).alias("parent"), F.coalesce("steps", F.array().cast("array<bigint>")).alias("load")))
    upper = _solve(quotient, m, level + 1, fragment_nodes).select(F.col("node").alias("exit"), F.col("path").alias("above"))
    own = solved.select("node", "exit", "steps")
    return own.join(upper, "exit", "left").select(
        "node",
        F.when(F.col("exit").isNull(), F.col("steps")).when(F.col("above").isNotNull(), F.concat("above", "steps")).alias("path"),
    )


def full_paths(links: DataFrame, fragment_nodes: int = FRAGMENT_NODES) -> DataFrame:
    """(node, path array<bigint>) for each row (node, parent) of ``links``, whose nodes must be distinct.

    ``path`` leads from the root to the node, both included; it is null for a node on or below a loop. A null parent
    makes a root. Nodes are spread over fragments; each fragment contracts its own parent chains to the exits
    that leave it. The exits, a smaller forest, are solved the same way with fewer fragments, until one fragment
    holds them, each carrying its steps; their paths are put before those of the fragments. Loops show in the fragment that holds them
    whole, at some level. Empty input gives no rows. The result is checkpointed, as trees are used
    again and again.
    """
    links, n = counted_cut(links.select("node", "parent"))
    return cut_lineage(_solve(links.withColumn("load", F.array("node")), n, 0, fragment_nodes))


def descendants(paths: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance): the closure below each node, itself left out."""
    n = F.size("path")
    return (
        paths.where(n > 1)
        .select(F.col("node").alias("descendant"), F.posexplode(F.slice("path", F.lit(1), n - 1)).alias("i", "ancestor"), n.alias("n"))
        .select("ancestor", "descendant", (F.col("n") - 1 - F.col("i")).alias("distance"))
    )


def hierarchy(links: DataFrame, fragment_nodes: int = FRAGMENT_NODES) -> DataFrame:
    """(node, root, depth int, n_descendants, path): one row for each node of ``links`` (node, parent).

    Depth is 0 for a root. A node on or below a loop has root, depth and n_descendants -1 and an empty path. Descendants are
    counted in the tasks first, so a root above most nodes costs one partial count for each task.
    """
    paths = full_paths(links, fragment_nodes)
    below = descendants(paths).groupBy(F.col("ancestor").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    lost = F.col("path").isNull()
    return paths.join(below, "node", "left").select(
        "node",
        F.when(lost, F.lit(-1)).otherwise(F.element_at("path", 1)).cast("bigint").alias("root"),
        F.when(lost, F.lit(-1)).otherwise(F.size("path") - 1).cast("int").alias("depth"),
        F.when(lost, F.lit(-1)).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("n_descendants"),
        F.coalesce("path", F.array().cast("array<bigint>")).alias("path"),
    )


def nearest_in(paths: DataFrame, marked: DataFrame) -> DataFrame:
    """(node, nearest): the nearest node of ``marked`` (node) on each node's way up, itself included; else null."""
    steps = paths.select("node", F.posexplode("path").alias("i", "a"))
    hit = steps.join(marked.select(F.col("node").alias("a")).distinct(), "a", "left_semi")
    return paths.select("node").join(hit.groupBy("node").agg(F.max_by("a", "i").alias("nearest")), "node", "left")

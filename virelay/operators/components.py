"""Connected components of links, by randomised contraction of the graph they make."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.session import counted_cut, cut_lineage

#: Contraction at least halves the vertices of most rounds; this many rounds are never needed.
MAX_ROUNDS = 200


def contract(edges: DataFrame, seed: int = 17) -> DataFrame:
    """(v, r): for each end of an edge (a, b), both bigint, one vertex of its connected component, the same for all of it.

    In each round all vertices draw fresh hashes; each hooks to the vertex of the smallest hash among itself and its neighbours, and, as that one
    has a hook too, to where the hook's hook goes. Edges are relabelled to the hooks; edges within a hook and repeated ones go. Mostly local minima
    of the hashes stay, a third of a chain and less of anything denser, so rounds grow with the logarithm of the vertices. The mappings
    of the rounds are then expanded from the last back to the first.

    A round is one job: its new edges and its mapping are checkpointed together, and the edges are counted on the way. A hook is a minimum, combined in
    the tasks, so a vertex with most of the edges costs one partial row for each task; the joins meet one mapping row for each vertex, and adaptive
    execution splits long runs of one vertex. Edges of a vertex with itself or null, and repeated or reversed ones, change nothing.
    """
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
    state, mappings = counted_cut(pairs.select(F.lit(True).alias("edge"), "x", "y"), F.col("edge")), []
    while state[1]:
        if len(mappings) == MAX_ROUNDS:
            raise RuntimeError(f"links are left after {MAX_ROUNDS} rounds")
        salt = F.lit(seed + len(mappings))
        now = state[0].where("edge").select("x", "y")
        ends = now.select(F.col("x").alias("v"), F.col("y").alias("u")).unionByName(now.select(F.col("y").alias("v"), F.col("x").alias("u")))
        near = ends.groupBy("v").agg(F.min(F.struct(F.xxhash64("u", salt).alias("h"), "u")).alias("n"))
        hooks = near.select("v", F.least("n", F.struct(F.xxhash64("v", salt).alias("h"), F.col("v").alias("u")))["u"].alias("r"))
        far = hooks.join(hooks.select(F.col("v").alias("r"), F.col("r").alias("rr")), "r").select("v", F.col("rr").alias("r"))
        moved = now.join(far.toDF("x", "rx"), "x").join(far.toDF("y", "ry"), "y").where("rx <> ry")
        moved = moved.select(F.lit(True).alias("edge"), F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y")).distinct()
        state = counted_cut(moved.unionByName(far.select(F.lit(False).alias("edge"), F.col("v").alias("x"), F.col("r").alias("y"))), F.col("edge"))
        mappings.append(state[0].where("NOT edge").toDF("edge", "v", "r").select("v", "r"))
    if not mappings:
        return pairs.limit(0).toDF("v", "r")
    labels = mappings.pop()
    while mappings:
        upper = labels.toDF("r", "top")
        labels = mappings.pop().join(upper, "r", "left").select("v", F.coalesce("top", "r").alias("r"))
        if len(mappings) % 4 == 0:  # short plans are cheap to replan
            labels = cut_lineage(labels)
    return labels


def numbered(names: DataFrame, name: str) -> DataFrame:
    """(name, id bigint) of each distinct non-null name; checkpointed, so the ids stay what they are."""
    return cut_lineage(names.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct().withColumn("id", F.monotonically_increasing_id()))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component, size): for every node of a link the least node it is connected to, and how many are. Nodes may be of any orderable type.

    Nodes get numbers once and all rounds work on these. Links with a null side or of a node with itself, and repeated ones, change nothing; no
    links give no rows.
    """
    links = links.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b"))
    ids = numbered(links.select(F.explode(F.array("a", "b")).alias("name")), "name")
    edges = links.join(ids.toDF("a", "ia"), "a").join(ids.toDF("b", "ib"), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    named = cut_lineage(contract(edges).join(ids.toDF("name", "v"), "v").select("r", "name"))
    least = named.groupBy("r").agg(F.min("name").alias("component"), F.count(F.lit(1)).alias("size"))
    return named.join(least, "r").select(F.col("name").alias("node"), "component", "size")

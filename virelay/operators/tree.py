"""Aggregates over a tree: lowest common ancestors, distances, clades, ranks, statuses.

Trees come as ``paths`` (node, path from the root down) of virelay.operators.hierarchy.full_paths; nodes on loops have
null paths and count as unknown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virelay.operators.hierarchy import descendants
from virelay.session import array_bytes, broadcast_if_small, cut_lineage

#: Ranks from the lowest up (fixed values).
RANKS = ["subspecies", "species", "subgenus", "genus", "subfamily", "family", "suborder", "order", "subclass", "class", "subphylum", "phylum", "kingdom", "superkingdom"]

#: States of an infection status (fixed values).
INCONSISTENT, MATCH, UNCLEAR, CONSISTENT, UNRESOLVED, MAYBE_INCONSISTENT = 0, 1, 2, 3, -1, -2


def shared_length(a: Column, b: Column) -> Column:
    """How many first elements two arrays have in common."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(a), F.size(b)))


def closure(paths: DataFrame, seeds: DataFrame) -> DataFrame:
    """(node): the seeds (node) and all nodes below them."""
    below = descendants(paths).join(seeds.select(F.col("node").alias("ancestor")).distinct(), "ancestor", "left_semi").select(F.col("descendant").alias("node"))
    return below.unionByName(seeds.select("node")).where("node IS NOT NULL").distinct()


def unclassified_nodes(paths: DataFrame, names: DataFrame) -> DataFrame:
    """(node): nodes one of whose names (node, name) holds "unclassified" or " sp.", and all nodes below them."""
    name = F.lower("name")
    return closure(paths, names.where(name.contains("unclassified") | name.contains(" sp.")).select("node"))


def lca_by_group(rows: DataFrame, group: str, taxid: str, score: str, ordinal: str, paths: DataFrame, unclassified: DataFrame | None = None, artificial_root: int | None = None, root: int = 1) -> DataFrame:
    """One row for each group, for the subsets combined, natural (no suffix) and artificial of its rows.

    For each subset: n_entries, n_classified, taxid_top, top_classified, min, max and mean score, and taxid_lca. The top is the row of the best score,
    classified before unclassified, then the smallest ordinal. The ancestor is that of all classified taxids, and of the best-scored
    unclassified ones only if no best-scored row is classified. One distinct taxid is its own ancestor, known or not;
    several with an unknown one among them, or without a shared ancestor, have ``root``. An empty subset has counts 0 and nulls. Artificial are the nodes
    on or below ``artificial_root``. Rows with a null group, taxid or score don't count. Repeated rows count as entries.

    The shared first part of a set of paths is that of its least and its greatest, so an ancestor is a minimum and a maximum of arrays:
    rows are combined in the tasks, first for each (group, score), then for each group, and no group is collected.
    """
    info = paths.select(F.col("node").alias("__n"), "path")
    if artificial_root is not None:
        info = info.withColumn("__art", F.array_contains("path", artificial_root))
    else:
        info = info.withColumn("__art", F.lit(False))
    if unclassified is not None:
        info = info.join(unclassified.select(F.col("node").alias("__n"), F.lit(True).alias("__unc")), "__n", "left")
    else:
        info = info.withColumn("__unc", F.lit(False))
    r = rows.select(F.col(group).alias("g"), F.col(taxid).cast("bigint").alias("t"), F.col(score).cast("double").alias("s"), F.col(ordinal).alias("o")).where("g IS NOT NULL AND t IS NOT NULL AND s IS NOT NULL")
    # equal (group, taxid, score) rows are one for all but the counts
    r = r.groupBy("g", "t", "s").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("o"))
    r = r.join(broadcast_if_small(info, array_bytes(paths, "path")), r.t == F.col("__n"), "left")
    c = ~F.coalesce("__unc", F.lit(False))
    art = F.coalesce("__art", F.lit(False))
    subsets = {"_combined": F.lit(True), "": ~art, "_artificial": art}
    known = F.coalesce("path", F.array().cast("array<bigint>"))
    per_score, per_group, final = [], [], [F.col("g").alias(group)]
    for k, inside in subsets.items():
        cl, un = inside & c, inside & ~c
        per_score += [
            F.sum(F.when(inside, F.col("n")).otherwise(0)).alias(f"n{k}"), F.sum(F.when(cl, F.col("n")).otherwise(0)).alias(f"c{k}"),
            F.min(F.when(inside, F.struct(c.cast("int") * -1, F.col("o"), F.col("t").alias("t"), c.alias("c")))).alias(f"top{k}"),
        ]
        for name, cond in (("cl", cl), ("un", un)):
            per_score += [F.min(F.when(cond, known)).alias(f"{name}lo{k}"), F.max(F.when(cond, known)).alias(f"{name}hi{k}"), F.min(F.when(cond, F.col("t"))).alias(f"{name}a{k}"), F.max(F.when(cond, F.col("t"))).alias(f"{name}b{k}")]
        there = F.col(f"n{k}") > 0
        s_in = F.when(there, F.col("s"))
        lone = F.col(f"c{k}") == 0
        best = F.struct(lone.alias("lone"), *[F.col(f"un{x}{k}").alias(x) for x in ("lo", "hi", "a", "b")], F.col(f"top{k}").alias("top"))
        per_group += [
            F.sum(f"n{k}").alias(f"n{k}"), F.sum(f"c{k}").alias(f"c{k}"), F.min(s_in).alias(f"smin{k}"), F.max(s_in).alias(f"smax{k}"), F.sum(F.when(there, F.col("s") * F.col(f"n{k}"))).alias(f"ssum{k}"),
            F.max_by(F.when(there, best), F.when(there, F.col("s"))).alias(f"best{k}"),
            *[F.min(f"cl{x}{k}").alias(f"cl{x}{k}") for x in ("lo", "a")], *[F.max(f"cl{x}{k}").alias(f"cl{x}{k}") for x in ("hi", "b")],
        ]
        extra = F.col(f"best{k}.lone")
        pick = {x: F.when(extra, f(F.col(f"cl{x}{k}"), F.col(f"best{k}.{x}"))).otherwise(F.col(f"cl{x}{k}")) for x, f in (("lo", F.least), ("a", F.least), ("hi", F.greatest), ("b", F.greatest))}
        shared = shared_length(pick["lo"], pick["hi"])
        lca = F.when(pick["a"] == pick["b"], pick["a"]).when(shared > 0, F.get(pick["lo"], shared - 1)).otherwise(F.when(pick["a"].isNotNull(), F.lit(root))).cast("bigint")
        final += [
            F.col(f"n{k}").alias(f"n_entries{k}"), F.col(f"c{k}").alias(f"n_classified{k}"), F.col(f"best{k}.top.t").alias(f"taxid_top{k}"), F.col(f"best{k}.top.c").alias(f"top_classified{k}"),
            F.col(f"smin{k}").alias(f"score_min{k}"), F.col(f"smax{k}").alias(f"score_max{k}"), F.round(F.col(f"ssum{k}") / F.col(f"n{k}"), 6).alias(f"score_mean{k}"), lca.alias(f"taxid_lca{k}"),
        ]
    return r.groupBy("g", "s").agg(*per_score).groupBy("g").agg(*per_group).select(*final)


def taxid_distance(df: DataFrame, first: str, second: str, paths: DataFrame, out_first: str = "distance_1", out_second: str = "distance_2") -> DataFrame:
    """Adds the steps from each taxid up to their lowest common ancestor; null where a taxid is null or unknown, or nothing is shared."""
    clash = {out_first, out_second} & set(df.columns)
    if clash:
        raise ValueError(f"columns exist: {sorted(clash)}")
    n = array_bytes(paths, "path")
    out = df
    for c, p in ((first, "__p1"), (second, "__p2")):
        side = broadcast_if_small(paths.select(F.col("node").alias(p + "n"), F.col("path").alias(p)), n)
        out = out.join(side, F.col(c) == F.col(p + "n"), "left").drop(p + "n")
    shared = shared_length(F.col("__p1"), F.col("__p2"))
    ok = F.col("__p1").isNotNull() & F.col("__p2").isNotNull() & (shared > 0)
    return out.withColumn(out_first, F.when(ok, F.size("__p1") - shared).cast("int")).withColumn(out_second, F.when(ok, F.size("__p2") - shared).cast("int")).drop("__p1", "__p2")


def raise_to_rank(paths: DataFrame, ranks: DataFrame, target: str, order: Sequence[str] = RANKS) -> DataFrame:
    """(node, raised): the first node on the way up, itself included, whose rank is in ``order`` at or above ``target``; null unless it is ``target``."""
    order = list(order)
    at = order.index(target)
    high = ranks.where(F.col("rank").isin(order[at:])).select(F.col("node").alias("a"), "rank")
    steps = paths.where("path IS NOT NULL").select("node", F.posexplode("path").alias("i", "a"))
    first = steps.join(high, "a").groupBy("node").agg(F.max(F.struct("i", "a", "rank")).alias("m"))
    return paths.select("node").join(first, "node", "left").select("node", F.when(F.col("m.rank") == target, F.col("m.a")).alias("raised"))


def clade_counts(rows: DataFrame, group: str, read: str, exemplar: str, taxid: str, links: DataFrame, paths: DataFrame, root_parent: int = 1) -> DataFrame:
    """(group, taxid, parent_taxid, reads_direct_total, _dedup, reads_clade_total, _dedup) of each taxon with reads on or below it.

    A read counts as dedup if it is its own exemplar. Rows whose taxid isn't in the tree are left out. Reads are counted for each
    (group, taxid) before counts, not reads, are carried up the paths; a root above most reads gets one partial sum for each task.
    """
    direct = rows.where(F.col(taxid).isNotNull()).groupBy(F.col(group).alias("group"), F.col(taxid).cast("bigint").alias("node")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce(F.col(read) == F.col(exemplar), F.lit(False))).alias("dedup")
    )
    up = direct.join(paths.where("path IS NOT NULL"), "node").select("group", "node", "total", "dedup", F.explode("path").alias("a"))
    own = F.col("node") == F.col("a")
    clade = up.groupBy("group", F.col("a").alias("taxid")).agg(
        F.sum(F.when(own, F.col("total")).otherwise(0)).alias("reads_direct_total"), F.sum(F.when(own, F.col("dedup")).otherwise(0)).alias("reads_direct_dedup"),
        F.sum("total").alias("reads_clade_total"), F.sum("dedup").alias("reads_clade_dedup"),
    )
    parents = links.select(F.col("node").alias("taxid"), F.coalesce("parent", F.lit(root_parent)).cast("bigint").alias("parent_taxid"))
    return clade.join(parents, "taxid").select("group", "taxid", "parent_taxid", "reads_direct_total", "reads_direct_dedup", "reads_clade_total", "reads_clade_dedup")


def infection_status(links: DataFrame, paths: DataFrame, hosts: DataFrame, host_group: DataFrame, hard_exclude: DataFrame | None = None, hard_include: DataFrame | None = None) -> DataFrame:
    """(node, status) by direct marks, then the way up, then the way down.

    ``hosts`` has (node, host), ``host_group`` (host). A node with hosts is MATCH if one is in the group, else INCONSISTENT; without, UNRESOLVED.
    Excluded nodes and all below are INCONSISTENT, included nodes MATCH. From the leaves up, a node that isn't MATCH takes: its own state if all
    children are unresolved; theirs if all are equal; UNCLEAR if one is, or if they are for and against; else INCONSISTENT or MAYBE_INCONSISTENT, or
    CONSISTENT. Then MATCH, INCONSISTENT, CONSISTENT and UNCLEAR go down to what is still open. Without any MATCH all are INCONSISTENT. A
    null path (loop) has a null status. The way up takes one round for each level of the tree, checkpointed; states of children are combined as bits.
    """
    mark = hosts.join(host_group.select("host").distinct().withColumn("hit", F.lit(1)), "host", "left").groupBy("node").agg(F.max(F.coalesce("hit", F.lit(0))).alias("direct"))
    base = paths.where("path IS NOT NULL").select("node", "path", (F.size("path") - 1).alias("depth")).join(links.select("node", "parent"), "node").join(mark, "node", "left")
    state = F.coalesce("direct", F.lit(UNRESOLVED))
    if hard_exclude is not None:
        ex = closure(paths, hard_exclude).withColumn("ex", F.lit(True))
        base, state = base.join(ex, "node", "left"), F.when(F.col("ex"), F.lit(INCONSISTENT)).otherwise(state)
    if hard_include is not None:
        inc = hard_include.select("node", F.lit(True).alias("inc")).distinct()
        base, state = base.join(inc, "node", "left"), F.when(F.col("inc"), F.lit(MATCH)).otherwise(state)
    base = cut_lineage(base.select("node", "parent", "path", "depth", state.cast("int").alias("s")))
    any_match = not base.where(F.col("s") == MATCH).isEmpty()
    if not any_match:
        return paths.select("node").join(base.select("node", F.lit(INCONSISTENT).alias("status")), "node", "left")
    deepest = base.agg(F.max("depth").alias("d")).first().d or 0
    bit = {v: 1 << (v + 2) for v in (-2, -1, 0, 1, 2, 3)}

    def has(bits: Column, *states: int) -> Column:
        return bits.bitwiseAND(sum(bit[v] for v in states)) != 0

    done = base.where(F.col("depth") == deepest).select("node", "parent", "s")
    level = done
    for d in range(deepest - 1, -1, -1):
        bits = level.where("parent IS NOT NULL").groupBy("parent").agg(F.bit_or(F.shiftleft(F.lit(1), 0) * F.pow(F.lit(2), F.col("s") + 2).cast("int")).alias("b"))
        here = base.where(F.col("depth") == d).join(bits.select(F.col("parent").alias("node"), "b"), "node", "left")
        b = F.col("b")
        single = F.when(b == bit[-2], -2)
        for v in (0, 1, 2, 3):
            single = single.when(b == bit[v], v)
        up = (
            F.when(b.isNull() | (F.col("s") == MATCH) | (b == bit[-1]), F.col("s"))
            .when(single.isNotNull(), single)
            .when(has(b, 2) | (has(b, 0, -2) & has(b, 1, 3)), F.lit(UNCLEAR))
            .when(has(b, 0, -2), F.when(F.col("s") == INCONSISTENT, INCONSISTENT).otherwise(MAYBE_INCONSISTENT))
            .otherwise(F.lit(CONSISTENT))
        )
        level = cut_lineage(here.select("node", "parent", up.cast("int").alias("s")))
        done = done.unionByName(level)
    done = cut_lineage(done)
    seen = paths.where("path IS NOT NULL").select("node", F.explode("path").alias("a")).join(done.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    over = seen.groupBy("node").agg(F.bit_or(F.pow(F.lit(2), F.col("sa") + 2).cast("int")).alias("b"))
    b, s = F.col("b"), F.col("s")
    status = F.when(has(b, 1), MATCH).when(has(b, 0), INCONSISTENT).when(has(b, 3), CONSISTENT).when((s < 0) & has(b, 2), UNCLEAR).otherwise(s)
    out = done.join(over, "node").select("node", status.cast("int").alias("status"))
    return paths.select("node").join(out, "node", "left")

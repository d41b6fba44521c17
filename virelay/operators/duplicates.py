"""Duplicate reads by near coordinates on a genome, and summaries of clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virelay.operators.components import contract
from virelay.session import cut_lineage

_PLACE = ("genome", "lo", "hi")


def normalised_place(genome: Column, start: Column, end: Column) -> list[Column]:
    """(genome, lo, hi): parts of ``a/b`` genomes sorted, coordinates following them; else the smaller coordinate first.

    A lone coordinate is ``lo``; ``hi`` is then null.
    """
    parts = F.split(genome, "/")
    two = F.size(parts) == 2
    flip = two & (F.get(parts, F.lit(0)) > F.get(parts, F.lit(1)))
    name = F.when(flip, F.concat(F.get(parts, F.lit(1)), F.lit("/"), F.get(parts, F.lit(0)))).otherwise(genome)
    one = start.isNull() | end.isNull()
    lo = F.when(one, F.coalesce(start, end)).when(two, F.when(flip, end).otherwise(start)).otherwise(F.least(start, end))
    hi = F.when(one, F.lit(None)).when(two, F.when(flip, start).otherwise(end)).otherwise(F.greatest(start, end))
    return [name.alias("genome"), lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi")]


def mark_duplicates(df: DataFrame, read: str, genome: str, start: str, end: str, quality: str, deviation: int = 1) -> tuple[DataFrame, DataFrame]:
    """Reads with their exemplar (read, exemplar), and groups (exemplar, genome, group_size, pairwise_match_frac).

    Two reads match if their genomes agree and both coordinates differ by at most ``deviation``; a missing coordinate matches
    a missing one only. Groups are the connected components of matches. The exemplar has the highest quality (null
    counts as 0), the smallest name at equal ones. The fraction is matching pairs over all pairs of the group, 1 for a lone read.
    Reads must be distinct; those with a null name, genome or start and end are left out.

    Reads are first combined by place, so identical places, however many, are one node, and each node looks up its few possible neighbours by
    an equi-join: the links grow with the places, not with pairs of reads.
    """
    q = F.coalesce(F.col(quality), F.lit(0.0)).cast("double")
    reads = df.where(F.col(read).isNotNull() & F.col(genome).isNotNull()).select(F.col(read).alias("read"), *normalised_place(F.col(genome), F.col(start), F.col(end)), q.alias("q")).where("lo IS NOT NULL")
    best = F.min(F.struct((-F.col("q")).alias("nq"), F.col("read").alias("name")))
    # places get numbers once; all that follows works on these
    places = reads.groupBy(*_PLACE).agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
    nodes = cut_lineage(places.withColumn("id", F.monotonically_increasing_id()))
    steps = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in range(deviation + 1) for y in range(-deviation, deviation + 1) if (x, y) > (0, 0)]
    near = nodes.select("id", "n", *_PLACE, F.explode(F.array(*steps) if steps else F.array().cast("array<struct<x:int,y:int>>")).alias("s")).where(F.col("hi").isNotNull() | (F.col("s.y") == 0))
    near = near.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("genome").alias("g"), (F.col("lo") + F.col("s.x")).alias("l"), (F.col("hi") + F.col("s.y")).alias("h"))
    on = (F.col("g") == F.col("genome")) & (F.col("l") == F.col("lo")) & F.col("h").eqNullSafe(F.col("hi"))
    links = cut_lineage(near.join(nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), *_PLACE), on).select("a", "b", (F.col("na") * F.col("nb")).alias("pairs")))
    placed = cut_lineage(nodes.join(contract(links).toDF("id", "r"), "id", "left").select("id", *_PLACE, "n", "best", F.coalesce("r", "id").alias("r")))
    pairs = links.groupBy(F.col("a").alias("id")).agg(F.sum("pairs").alias("pairs")).join(placed.select("id", "r"), "id").groupBy("r").agg(F.sum("pairs").alias("linked"))
    sizes = placed.groupBy("r").agg(F.min("genome").alias("genome"), F.sum("n").alias("size"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("same"), F.min("best").alias("best"))
    groups = sizes.join(pairs, "r", "left").select(
        "r", F.col("best.name").alias("exemplar"), "genome", F.col("size").alias("group_size"),
        F.when(F.col("size") > 1, F.round((F.col("same") + F.coalesce("linked", F.lit(0))) / (F.col("size") * (F.col("size") - 1) / 2), 6)).otherwise(F.lit(1.0)).alias("pairwise_match_frac"),
    )
    groups = cut_lineage(groups)
    named = placed.select("r", *_PLACE).join(groups.select("r", "exemplar"), "r").select(*_PLACE, "exemplar").toDF("g", "l", "h", "exemplar")
    marked = reads.join(named, (F.col("genome") == F.col("g")) & (F.col("lo") == F.col("l")) & F.col("hi").eqNullSafe(F.col("h")))
    return marked.select(F.col("read").alias(read), "exemplar"), groups.select("exemplar", "genome", "group_size", "pairwise_match_frac")


def combined_duplicates(df: DataFrame, read: str, exemplar: str, similar: DataFrame) -> DataFrame:
    """(read, sim_exemplar, sim_group_size): similarity groups over reads that are unique by alignment.

    ``similar`` has (read, sim_exemplar) of those reads. A sim exemplar's row carries the sum of the alignment groups it
    stands for; other unique reads carry null, reads that aren't unique carry null in both columns.
    """
    counts = df.groupBy(F.col(exemplar).alias("read")).agg(F.count(F.lit(1)).alias("n"))
    of = similar.select(F.col(read).alias("read"), "sim_exemplar")
    size = of.join(counts, "read").groupBy("sim_exemplar").agg(F.sum("n").alias("size"))
    unique = df.where(F.col(read) == F.col(exemplar)).select(F.col(read).alias("read")).join(of, "read", "left")
    own = size.select(F.col("sim_exemplar").alias("read"), F.col("size"))
    marked = unique.join(own, "read", "left")
    return df.select(F.col(read).alias("read")).join(marked, "read", "left").select(F.col("read").alias(read), "sim_exemplar", F.col("size").alias("sim_group_size"))


def cluster_summary(records: DataFrame, prefix: str = "vsearch_") -> DataFrame:
    """Members of clusters from records (type, cluster, length, identity, orientation, cigar, query, target).

    Type C gives a cluster's size, S its representative, H a member; a representative has identity 100, ``+`` and ``<length>M``.
    """
    size = records.where("type = 'C'").select("cluster", F.col("length").alias("size"))
    member = records.where("type IN ('S', 'H')").select(
        F.col("query").alias("seq_id"), F.col("cluster").alias("cluster_id"),
        F.when(F.col("type") == "S", F.col("query")).otherwise(F.col("target")).alias("cluster_rep_id"), F.col("length").alias("seq_length"),
        (F.col("type") == "S").alias("is_cluster_rep"),
        F.when(F.col("type") == "S", 100.0).otherwise(F.col("identity").try_cast("double")).alias("percent_identity"),
        F.when(F.col("type") == "S", "+").otherwise(F.col("orientation")).alias("orientation"),
        F.when(F.col("type") == "S", F.concat(F.col("length").cast("string"), F.lit("M"))).otherwise(F.col("cigar")).alias("cigar"),
    )
    out = member.join(size.select(F.col("cluster").alias("cluster_id"), F.col("size").alias("cluster_size")), "cluster_id")
    return out.select("seq_id", *[F.col(c).alias(prefix + c) for c in out.columns if c != "seq_id"])


def top_representatives(members: DataFrame, n: int, prefix: str = "vsearch_") -> DataFrame:
    """(rep_id, size) of the ``n`` largest clusters, the smaller name first at equal sizes."""
    reps = members.where(F.col(prefix + "is_cluster_rep")).select(F.col(prefix + "cluster_rep_id").alias("rep_id"), F.col(prefix + "cluster_size").alias("size"))
    return reps.orderBy(F.col("size").desc(), "rep_id").limit(n)

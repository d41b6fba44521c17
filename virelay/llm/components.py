"""Pairwise matches to groups, by randomised contraction of the graph of matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.operators.components import components


def linked_groups(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(name, group_name, group_size) of every name that a pair links to another; the group is named by its smallest name.

    Names get numbers once. In each round all vertices draw fresh hashes and hook to the neighbour of the smallest one, links are relabelled and
    deduplicated, and the rounds' mappings are expanded at last (virelay.operators.components.contract). Repeated and reversed pairs change nothing; pairs with a null
    side or of a record with itself link nothing; without links there are no rows.
    """
    return components(pairs, a, b).select(F.col("node").alias("name"), F.col("component").alias("group_name"), F.col("size").alias("group_size"))


def all_groups(names: DataFrame, name: str, linked: DataFrame) -> DataFrame:
    """(name, group_name, group_size) of each distinct non-null name; one that nothing links is a group of its own."""
    every = names.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()
    return every.join(linked, "name", "full").select(
        "name", F.coalesce("group_name", "name").alias("group_name"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size")
    )

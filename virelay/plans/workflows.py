"""Compositions: from alignments to annotated hits, from hits to group tables, from clusters to validated hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.operators import align, duplicates, hierarchy, joins, relops, tree
from virelay.sources import writers


def hits_from_sam(sam: DataFrame, genomes: DataFrame, threshold: float, viral: DataFrame | None = None) -> DataFrame:
    """Short-read alignments to one row for each placement: groups, score filter, pairing. A mate that isn't placed needs no row of its own for that."""
    return align.paired_hits(align.filter_by_score(sam, threshold), genomes, viral)


def annotated_hits(alignments: DataFrame, links: DataFrame, sample: str, unclassified: DataFrame | None = None, artificial_root: int | None = 81077) -> DataFrame:
    """Each read's ancestors beside its primary alignment. ``alignments`` has seq_id, taxid, length_normalized_score, row_no, classification."""
    paths = hierarchy.full_paths(links)
    lca = tree.lca_by_group(alignments, "seq_id", "taxid", "length_normalized_score", "row_no", paths, unclassified, artificial_root)
    return align.primary_with_lca(lca, alignments).withColumn("sample", F.lit(sample))


def duplicates_and_clades(hits: DataFrame, links: DataFrame, group: str, read: str, genome: str, start: str, end: str, quality: str, taxid: str, deviation: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(marked hits, duplicate groups, clade counts) of a group table."""
    marked, groups = duplicates.mark_duplicates(hits, read, genome, start, end, quality, deviation)
    both = hits.join(marked, read)
    clades = tree.clade_counts(both, group, read, "exemplar", taxid, links, hierarchy.full_paths(links))
    return both, groups, clades


def by_species(hits: DataFrame, virus_db: DataFrame, taxid: str = "aligner_taxid_lca") -> DataFrame:
    """Hits with taxid_species and selected_taxid: the species where there is one, else the hit's own taxid."""
    db = relops.rename_columns(relops.keep_columns(relops.assert_unique(virus_db, ["taxid"]), ["taxid", "taxid_species"]), ["taxid"], [taxid])
    j = joins.checked_join(hits, db, taxid, "left", check=False)
    return relops.add_conditional_column(j, "selected_taxid", "taxid_species", None, taxid, "taxid_species")


def search_lca(search: DataFrame, paths: DataFrame, unclassified: DataFrame | None = None, max_rank: int = 10, min_fraction: float = 0.9) -> DataFrame:
    """Ancestors of each query of a search report: the best row for each (query, subject), rank and fraction filter, aggregate.

    ``search`` has qseqid, sseqid, staxid, bitscore, length and ordinal.
    """
    best = relops.distinct_on(search, ["qseqid", "sseqid"], [-F.col("bitscore"), -F.col("length"), F.col("ordinal")])
    good = relops.rank_fraction_filter(best, "qseqid", "bitscore", max_rank, min_fraction)
    return tree.lca_by_group(good, "qseqid", "staxid", "bitscore", "ordinal", paths, unclassified)


def validate_hits(hits: DataFrame, members: DataFrame, rep_lca: DataFrame, paths: DataFrame, taxid: str = "aligner_taxid_lca") -> DataFrame:
    """Hits with their cluster's validation: distances between a representative's own taxid and the search's.

    ``members`` is a cluster_summary, ``rep_lca`` has (seq_id, validation_lca) of representatives. Every hit must have a cluster and the other way
    round; clusters without validation have nulls.
    """
    own = joins.checked_join(relops.keep_columns(hits, ["seq_id", taxid]), rep_lca, "seq_id", "inner")
    dist = tree.taxid_distance(own, taxid, "validation_lca", paths, "validation_distance_aligner", "validation_distance_validation")
    rep = relops.rename_columns(dist.drop(taxid), ["seq_id"], ["vsearch_cluster_rep_id"])
    spread = joins.checked_join(members, rep, "vsearch_cluster_rep_id", "left")
    return joins.checked_join(hits, spread.drop("group"), "seq_id", "strict")


def by_group(tables: list[DataFrame], groups: DataFrame) -> DataFrame:
    """Tables of samples as one table with a column ``group``; samples without a group are left out."""
    return relops.union_by_header(tables).join(groups.select("sample", "group"), "sample")


def profile_tables(reports: dict[str, DataFrame]) -> DataFrame:
    """Reports of ribosomal (``TRUE``) and other (``FALSE``) reads as one table with the column ``ribosomal``."""
    return relops.union_by_header([df.withColumn("ribosomal", F.lit(flag)) for flag, df in reports.items()])


def validated_groups(hits: DataFrame, virus_db: DataFrame, members: DataFrame, search: DataFrame, paths: DataFrame, groups: DataFrame, taxid: str = "aligner_taxid_lca") -> tuple[DataFrame, DataFrame]:
    """(validated hits, groups without any): clusters of each species, their representatives' search results, distances, and the hits they stand for.

    ``hits`` has seq_id, ``taxid`` and group; ``members`` is a cluster_summary of them, ``search`` a report of representatives with an ordinal, ``groups`` has (group).
    """
    found = search_lca(search, paths).select(F.col("qseqid").alias("seq_id"), F.col("taxid_lca_combined").alias("validation_lca"))
    split = by_species(hits, virus_db, taxid)
    out = validate_hits(split, members, found, paths, taxid).drop("taxid_species", "selected_taxid")
    return out, writers.empty_outputs(groups, out)

"""Reference tables: the taxonomy of viruses with ranks and host statuses, and the genomes that go with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.operators import hierarchy, reads, tree
from virelay.operators.relops import TableError
from virelay.session import cut_lineage
from virelay.sources.readers import preferred_names

#: Ranks to which each taxon is raised (fixed values).
RAISED = ["species", "genus", "family", "order", "class", "phylum"]


def virus_taxonomy(
    nodes: DataFrame, names: DataFrame, root: int, hosts: DataFrame, host_groups: dict[str, DataFrame],
    hard_exclude: DataFrame | None = None, hard_include: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(taxid, name, rank, parent_taxid, taxid_<rank> for each of RAISED, infection_status_<group> for each of ``host_groups``) of ``root`` and all taxa below it.

    ``nodes`` has (node, parent, rank), ``names`` (node, name, name_class), ``hosts`` (node, host), a group (host). ``hard_exclude`` and, for each group,
    ``hard_include`` have (node). Taxa on loops aren't below the root. Paths are made once for the whole taxonomy and cut at the root; each rank and
    status is a join by taxon.
    """
    paths = hierarchy.full_paths(hierarchy.latest_links(nodes, "node", "parent")).where(F.array_contains("path", root))
    begin = F.array_position("path", F.lit(root)).cast("int")
    paths = cut_lineage(paths.select("node", F.slice("path", begin, F.size("path") - begin + 1).alias("path")))
    links = nodes.join(paths.select("node"), "node", "left_semi").groupBy("node").agg(F.min_by("rank", "parent").alias("rank"), F.min("parent").alias("parent"))
    links = cut_lineage(links.select("node", F.when(F.col("node") != root, F.col("parent")).alias("parent"), "rank"))
    named = links.join(preferred_names(names), "node", "left")
    out = named.select(F.col("node").alias("taxid"), F.coalesce("name", F.lit("unknown virus")).alias("name"), F.coalesce("rank", F.lit("no rank")).alias("rank"), F.coalesce("parent", F.lit(root)).alias("parent_taxid"))
    for rank in RAISED:
        out = out.join(tree.raise_to_rank(paths, links.select("node", "rank"), rank).toDF("taxid", f"taxid_{rank}"), "taxid", "left")
    for group, members in host_groups.items():
        status = tree.infection_status(links.select("node", "parent"), paths, hosts, members, hard_exclude, (hard_include or {}).get(group))
        out = out.join(status.toDF("taxid", f"infection_status_{group}"), "taxid", "left")
    return out


def infecting_taxa(virus_db: DataFrame, groups: list[str]) -> DataFrame:
    """(taxid) of the taxa that match one of the host groups."""
    hit = F.lit(False)
    for g in groups:
        hit = hit | F.coalesce(F.col(f"infection_status_{g}") == tree.MATCH, F.lit(False))
    return virus_db.where(hit).select("taxid")


def virus_genomes(assemblies: DataFrame, virus_db: DataFrame, fasta: DataFrame, groups: list[str], exclude: list[str], assembly_status: str = "current") -> tuple[DataFrame, DataFrame]:
    """(metadata, sequences): one row for each sequence of the assemblies that are kept, and the sequences themselves, unwanted headers left out.

    ``assemblies`` has accession, taxid and assembly_status, ``fasta`` (file, seq_id, description, seq) of read_fasta. An assembly is kept if it has the status and its taxon or that one's species
    matches a host group; none at all is an error. The first file of an accession counts, and the first sequence of a name. A taxon that ``virus_db`` lacks has a null species.
    """
    species = virus_db.select("taxid", F.col("taxid_species").alias("species_taxid"))
    kept = cut_lineage(reads.screen_genomes(assemblies.join(species, "taxid", "left"), infecting_taxa(virus_db, groups), assembly_status))
    if kept.isEmpty():
        raise TableError("no assembly is kept")
    table = reads.genome_metadata(fasta.select("file", F.col("seq_id").alias("genome_id")), kept)
    mine = fasta.join(table.select("file", F.col("genome_id").alias("seq_id")).distinct(), ["file", "seq_id"], "left_semi")
    header = F.concat_ws(" ", "seq_id", "description")
    wanted = reads.without_headers_like(reads.first_by_name(mine, "seq_id", ["file"]).withColumn("header", header), "header", exclude)
    return table, wanted.drop("header")

"""Queries of the problems on text corpora and large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from virelay.llm import bpe, components, mixing, sentences, top_n
from virelay.session import spread_scan, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return top_n.top_n(table(spark, d, "tab_minimap"), "seq_id", "taxid", "best_alignment_score", 3).select("seq_id", "rank_no", "taxid")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    linked = components.linked_groups(table(spark, d, "duplicate_group"), "query_name", "exemplar_name")
    return linked.select(F.col("name").alias("query_name"), "group_name")


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    pairs, reads = table(spark, d, "duplicate_group"), table(spark, d, "read_entry")
    names = reads.select("query_name").unionByName(pairs.select("query_name")).unionByName(pairs.select(F.col("exemplar_name").alias("query_name")))
    return components.all_groups(names, "query_name", components.linked_groups(pairs, "query_name", "exemplar_name")).withColumnRenamed("name", "query_name")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"), ["doc_id"])


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    counts = bpe.token_counts(table(spark, d, "documents"), ["doc_id", "source"])
    return mixing.mix(counts, table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(spread_scan(table(spark, d, "documents")))


QUERIES = {f.__name__: f for f in (p3_found, p5_found, p5_groups, p7_ids, p8_mix, p8_shares, p9_found)}

_GROUPS = """WITH RECURSIVE links AS (
    SELECT DISTINCT query_name a, exemplar_name b FROM duplicate_group WHERE query_name <> exemplar_name
    UNION SELECT exemplar_name, query_name FROM duplicate_group WHERE query_name <> exemplar_name),
  reach(a, b) AS (SELECT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
  linked AS (SELECT a query_name, min(b) group_name, count(*) group_size FROM reach GROUP BY a)"""

ORACLE = {
    "p3_found": """SELECT seq_id, rank_no, taxid FROM (
        SELECT seq_id, taxid, CAST(row_number() OVER (PARTITION BY seq_id ORDER BY s DESC, taxid) AS INT) rank_no
        FROM (SELECT seq_id, taxid, max(best_alignment_score) s FROM tab_minimap
          WHERE seq_id IS NOT NULL AND taxid IS NOT NULL AND best_alignment_score IS NOT NULL GROUP BY seq_id, taxid))
      WHERE rank_no <= 3""",
    "p5_found": _GROUPS + " SELECT query_name, group_name FROM linked",
    "p5_groups": _GROUPS
    + """ SELECT n.query_name, coalesce(l.group_name, n.query_name) group_name, coalesce(l.group_size, 1) group_size
      FROM (SELECT query_name FROM read_entry UNION SELECT query_name FROM duplicate_group UNION SELECT exemplar_name FROM duplicate_group) n
      LEFT JOIN linked l USING (query_name) WHERE n.query_name IS NOT NULL""",
}

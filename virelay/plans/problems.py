"""Queries of the general problems over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from virelay.operators import hierarchy as h
from virelay.operators.hot_keys import heavy_keys, key_summary
from virelay.operators.orphans import Entity, Reference, orphan_report, orphans
from virelay.operators.packed import explode_packed
from virelay.session import table

VIRUS = Entity("test_virus_db", "taxid", "loaded_at", "deleted_at", "parent_taxid")
HOST = Entity("host_nodes", "taxid", "loaded_at", "deleted_at", "parent_taxid")
REFERENCES = [
    Reference("tab_minimap", "taxid", "row_no", "aligned_at", "test_virus_db"),
    Reference("test_infection_db", "virus_tax_id", "row_no", "noted_at", "test_virus_db"),
    Reference("test_infection_db", "host_tax_id", "row_no", "noted_at", "host_nodes"),
]
PACKED = ["genome_id", "genome_id_all", "taxid_all"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for t in ("read_entry", "tab_minimap"):
        one = heavy_keys(table(spark, d, t), "genome_id", 3).select(F.lit(t).alias("table_name"), "genome_id")
        out = one if out is None else out.unionByName(one)
    return out


def p1_genomes(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        key_summary(table(spark, d, t), "genome_id", m, v).select(F.lit(t).alias("table_name"), "*")
        for t, m, v in (("read_entry", "query_name", "avg_quality"), ("tab_minimap", "seq_id", "best_alignment_score"))
    ]
    return parts[0].unionByName(parts[1])


def _links(spark: SparkSession, d: str) -> DataFrame:
    return h.latest_links(table(spark, d, "test_virus_db"), "taxid", "parent_taxid", "loaded_at")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return h.hierarchy(_links(spark, d)).select(
        F.col("node").alias("taxid"), F.col("root").alias("root_taxid"), "depth", "n_descendants",
        F.array_join(F.col("path").cast("array<string>"), "/").alias("full_path"),
    )


def p2_descendants(spark: SparkSession, d: str) -> DataFrame:
    return h.descendants(h.full_paths(_links(spark, d))).select(F.col("ancestor").alias("taxid"), F.col("descendant").alias("descendant_taxid"), "distance")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return explode_packed(table(spark, d, "tab_minimap"), "row_no", PACKED, least=2)


def p4_values(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each value of each field, single ones too."""
    values = explode_packed(table(spark, d, "tab_minimap"), "row_no", PACKED)
    return values.groupBy("field_name", "item_text").agg(F.count(F.lit(1)).alias("n_values"), F.max("pos").alias("max_pos"))


def _orphan_rows(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], list[Reference], list[Entity]]:
    """The tables of the problem. Parent 0 marks a root, not a missing record."""
    tables = {t: table(spark, d, t) for t in ("tab_minimap", "test_infection_db", "test_virus_db", "host_nodes")}
    for e in (VIRUS, HOST):
        tables[e.table] = tables[e.table].withColumn(e.parent, F.nullif(F.col(e.parent), F.lit(0)))
    return tables, REFERENCES, [VIRUS, HOST]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The direct orphans of the cascade."""
    found = orphans(*_orphan_rows(spark, d)).where("kind <> 'inherited'")
    return found.select("ref_table", "ref_field", "row_no", "kind", F.date_format("ref_at", "yyyy-MM").alias("period_month"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Direct and inherited orphans for each table, field and month."""
    return orphan_report(*_orphan_rows(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_genomes, p2_found, p2_descendants, p4_found, p4_values, p6_found, p6_report)}

_LATEST = """latest AS (SELECT taxid, parent_taxid FROM (SELECT *, row_number() OVER (PARTITION BY taxid ORDER BY loaded_at DESC, parent_taxid NULLS LAST) r FROM test_virus_db WHERE taxid IS NOT NULL) WHERE r = 1),
  links AS (SELECT taxid, CASE WHEN parent_taxid <> taxid AND parent_taxid IN (SELECT taxid FROM latest) THEN parent_taxid END p FROM latest),
  tree AS (SELECT taxid, taxid root, 0 depth, [taxid] path FROM links WHERE p IS NULL
    UNION ALL SELECT l.taxid, t.root, t.depth + 1, list_append(t.path, l.taxid) FROM tree t JOIN links l ON l.p = t.taxid)"""


def _summary(t: str, m: str, v: str) -> str:
    x = f"CAST(CASE WHEN NOT isnan({v}::double) THEN {v} END AS DECIMAL(28,6))"
    return f"""SELECT '{t}' table_name, genome_id, count(*) n_rows, count(DISTINCT {m}) n_members, count({x}) n_values,
      round(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0), 6) mean_value, CAST(min({x}) AS DOUBLE) min_value, CAST(max({x}) AS DOUBLE) max_value
      FROM {t} WHERE genome_id IS NOT NULL GROUP BY genome_id"""


def _orphans(t: str, f: str, at: str, to: str) -> str:
    return f"""SELECT '{t}' ref_table, '{f}' ref_field, row_no,
        CASE WHEN NOT EXISTS (SELECT 1 FROM {to} v WHERE v.taxid = r.{f}) THEN 'missing'
             WHEN (SELECT min(loaded_at) FROM {to} v WHERE v.taxid = r.{f}) > r.{at} THEN 'late' ELSE 'deleted' END kind,
        strftime({at}, '%Y-%m') period_month
      FROM {t} r WHERE {f} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {to} v WHERE v.taxid = r.{f} AND v.loaded_at <= r.{at} AND (v.deleted_at IS NULL OR v.deleted_at > r.{at}))"""


_FOUND6 = " UNION ALL ".join(_orphans(r.table, r.field, r.at, r.to) for r in REFERENCES)

ORACLE = {
    "p1_found": " UNION ALL ".join(
        f"SELECT '{t}' table_name, genome_id FROM {t} WHERE genome_id IS NOT NULL GROUP BY genome_id HAVING count(*) * 100 >= 3 * (SELECT count(*) FROM {t})"
        for t in ("read_entry", "tab_minimap")
    ),
    "p1_genomes": _summary("read_entry", "query_name", "avg_quality") + " UNION ALL " + _summary("tab_minimap", "seq_id", "best_alignment_score"),
    "p2_found": f"""WITH RECURSIVE {_LATEST},
      below AS (SELECT a taxid, count(*) n FROM (SELECT unnest(path[:-2]) a FROM tree) GROUP BY a)
      SELECT l.taxid, coalesce(t.root, -1) root_taxid, CAST(coalesce(t.depth, -1) AS INT) depth,
        CASE WHEN t.taxid IS NULL THEN -1 ELSE coalesce(b.n, 0) END n_descendants, coalesce(array_to_string(t.path, '/'), '') full_path
      FROM links l LEFT JOIN tree t USING (taxid) LEFT JOIN below b ON b.taxid = l.taxid""",
    "p2_descendants": f"""WITH RECURSIVE {_LATEST}
      SELECT path[i] taxid, taxid descendant_taxid, CAST(len(path) - i AS INT) distance FROM (SELECT taxid, path, unnest(range(1, len(path))) i FROM tree)""",
    "p6_found": _FOUND6,
    "p6_report": f"""WITH RECURSIVE
      edges AS (SELECT t, k, pk FROM (SELECT *, row_number() OVER (PARTITION BY t, k ORDER BY loaded_at DESC, pk NULLS LAST) r
        FROM (SELECT 'test_virus_db' t, taxid k, nullif(parent_taxid, 0) pk, loaded_at FROM test_virus_db
          UNION ALL SELECT 'host_nodes', taxid, nullif(parent_taxid, 0), loaded_at FROM host_nodes) WHERE k IS NOT NULL) WHERE r = 1),
      lost AS (SELECT t, k FROM edges e WHERE pk IS NOT NULL AND pk <> k AND NOT EXISTS (SELECT 1 FROM edges x WHERE x.t = e.t AND x.k = e.pk)
        UNION SELECT e.t, e.k FROM edges e JOIN lost l ON l.t = e.t AND l.k = e.pk),
      direct AS ({_FOUND6}),
      inherited AS ({" UNION ALL ".join(f"SELECT '{r.table}' ref_table, '{r.field}' ref_field, row_no, 'inherited' kind, strftime({r.at}, '%Y-%m') period_month FROM {r.table} r WHERE EXISTS (SELECT 1 FROM lost l WHERE l.t = '{r.to}' AND l.k = r.{r.field}) AND EXISTS (SELECT 1 FROM {r.to} v WHERE v.taxid = r.{r.field} AND v.loaded_at <= r.{r.at} AND (v.deleted_at IS NULL OR v.deleted_at > r.{r.at}))" for r in REFERENCES)})
      SELECT ref_table, ref_field, period_month, kind, count(*) n_refs FROM (SELECT * FROM direct UNION ALL SELECT * FROM inherited) GROUP BY ALL""",
}

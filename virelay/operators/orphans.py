"""References to records that don't exist, or not at the time of the reference."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from virelay.session import counted_cut, cut_lineage


@dataclass(frozen=True)
class Reference:
    """A column that refers to the key of a versioned table at some time."""

    table: str
    field: str
    row_id: str
    at: str
    to: str


@dataclass(frozen=True)
class Entity:
    """A versioned table: a row of ``key`` is valid from ``since`` until just before ``until`` (null: without end)."""

    table: str
    key: str
    since: str
    until: str
    parent: str | None = None
    parent_table: str | None = None


def valid_spans(df: DataFrame, e: Entity) -> DataFrame:
    """(key, since, until): the times at which some row of the key is valid, overlapping or touching spans merged.

    Rows with a null key or start, and spans that end before they begin, are never valid. Versions are combined for
    each (key, since) before the window, so redelivered rows cost nothing.
    """
    far = F.lit("9999-12-31 00:00:00").cast(df.schema[e.since].dataType)
    spans = (
        df.where(F.col(e.key).isNotNull() & F.col(e.since).isNotNull())
        .groupBy(F.col(e.key).alias("__key"), F.col(e.since).alias("since"))
        .agg(F.max(F.coalesce(F.col(e.until), far)).alias("until"))
        .where(F.col("until") > F.col("since"))
    )
    w = Window.partitionBy("__key").orderBy("since", "until")
    seen = F.max("until").over(w.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("since") <= F.col("seen"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        spans.withColumn("seen", seen).withColumn("run", run).groupBy("__key", "run").agg(F.min("since").alias("since"), F.max("until").alias("until"))
        .select("__key", "since", "until")
    )


def _judged(refs: DataFrame, r: Reference, entity: DataFrame, e: Entity, lost: DataFrame | None = None) -> DataFrame:
    """(ref_table, ref_field, row_no, ref_key, ref_at, kind) of orphan references; those to valid records of the keys in ``lost`` (k) are inherited.

    Spans of a key don't overlap, so a reference meets one at most, and one row with what is known of its key.
    """
    side = refs.where(F.col(r.field).isNotNull()).select(
        F.col(r.row_id).alias("row_no"), F.col(r.field).cast("bigint").alias("ref_key"), F.col(r.at).alias("ref_at")
    )
    spans = valid_spans(entity, e).select(F.col("__key").cast("bigint").alias("k"), "since", "until")
    keys = entity.where(F.col(e.key).isNotNull()).groupBy(F.col(e.key).cast("bigint").alias("k")).agg(F.min(e.since).alias("first_since"))
    keys = keys.withColumn("lost", F.lit(False)) if lost is None else keys.join(lost.withColumn("lost", F.lit(True)), "k", "left")
    within = (side.ref_key == spans.k) & (side.ref_at >= spans.since) & (side.ref_at < spans.until)
    met = side.join(spans, within, "left_anti").withColumn("valid", F.lit(False)) if lost is None else side.join(spans, within, "left").select("row_no", "ref_key", "ref_at", F.col("since").isNotNull().alias("valid"))
    kind = (
        F.when(F.col("valid"), F.when(F.col("lost"), "inherited")).when(F.col("k").isNull(), "missing")
        .when(F.col("ref_at") < F.col("first_since"), "late").otherwise("deleted")
    )
    judged = met.join(keys, F.col("ref_key") == F.col("k"), "left").select(F.lit(r.table).alias("ref_table"), F.lit(r.field).alias("ref_field"), "row_no", "ref_key", "ref_at", kind.alias("kind"))
    return judged.where(F.col("kind").isNotNull())


def direct_orphans(refs: DataFrame, r: Reference, entity: DataFrame, e: Entity) -> DataFrame:
    """(ref_table, ref_field, row_no, ref_key, ref_at, kind) of references without a row valid at their time.

    ``kind`` is ``missing`` if the key has no row, ``late`` if all its rows begin later, else ``deleted``. Null
    references refer to nothing. A reference without a time is never valid: it is ``missing`` or ``deleted``.
    Repeated rows all count. An empty entity makes every reference ``missing``. Both joins meet one compact row
    for each key or span, so a hot key only makes a long run of references, which adaptive execution splits.
    """
    return _judged(refs, r, entity, e)


def orphan_entities(tables: dict[str, DataFrame], entities: list[Entity]) -> DataFrame:
    """(entity_table, entity_key, inherited): keys whose parent can't be found, and all keys below them.

    The latest version of a key counts, of equally late ones that with the smallest parent. The first round finds keys that
    hold a non-null parent of which the parent table has no key at all; a key that is its own parent is a root. Each
    later round semi-joins the keys not yet found to those found before. Between rounds, the links of keys
    not yet found are joined to themselves, so round i reaches 2**i steps further down and the rounds grow with the
    logarithm of the depth; links that reach a root drop out, and loops end because a round then finds nothing new.
    ``inherited`` is false for the first round. Empty tables give no rows.
    """
    edges = None
    for e in entities:
        up = F.col(e.parent).cast("bigint")
        one = (
            tables[e.table].where(F.col(e.key).isNotNull()).groupBy(F.col(e.key).cast("bigint").alias("k"))
            .agg(F.max_by(up, F.struct(F.col(e.since).alias("v"), (-up).alias("p"))).alias("pk"))
            .select(F.lit(e.table).alias("t"), "k", F.lit(e.parent_table or e.table).alias("pt"), "pk")
        )
        edges = one if edges is None else edges.unionByName(one)
    edges = cut_lineage(edges)
    keys = edges.select(F.col("t").alias("pt"), F.col("k").alias("pk"))
    links = edges.where(F.col("pk").isNotNull() & ~((F.col("pk") == F.col("k")) & (F.col("pt") == F.col("t"))))
    new = links.join(keys, ["pt", "pk"], "left_anti").select("t", "k")
    found = cut_lineage(new.withColumn("inherited", F.lit(False)))
    jumps = links.join(found.select("t", "k"), ["t", "k"], "left_anti").select("t", "k", "pt", "pk")
    while True:
        jumps = cut_lineage(jumps)
        new, n = counted_cut(jumps.join(found.select(F.col("t").alias("pt"), F.col("k").alias("pk")), ["pt", "pk"], "left_semi").select("t", "k"))
        if not n:
            break
        found = found.unionByName(new.withColumn("inherited", F.lit(True)))
        open_ = jumps.join(new, ["t", "k"], "left_anti")
        step = jumps.select(F.col("t").alias("pt"), F.col("k").alias("pk"), F.col("pt").alias("nt"), F.col("pk").alias("nk"))
        jumps = open_.join(step, ["pt", "pk"]).select("t", "k", F.col("nt").alias("pt"), F.col("nk").alias("pk"))
    return found.select(F.col("t").alias("entity_table"), F.col("k").alias("entity_key"), "inherited")


def orphans(tables: dict[str, DataFrame], references: list[Reference], entities: list[Entity]) -> DataFrame:
    """(ref_table, ref_field, row_no, ref_key, ref_at, kind): orphan references, direct and inherited; each comes once.

    ``kind`` is missing, late or deleted for direct orphans, as in direct_orphans; ``inherited`` for references whose own record
    is valid at their time but an orphan itself, or below one, by the cascade of orphan_entities.
    """
    by = {e.table: e for e in entities}
    lost = orphan_entities(tables, [e for e in entities if e.parent])
    parts = [_judged(tables[r.table], r, tables[r.to], by[r.to], lost.where(F.col("entity_table") == r.to).select(F.col("entity_key").alias("k"))) for r in references]
    return reduce(DataFrame.unionByName, parts)


def orphan_report(tables: dict[str, DataFrame], references: list[Reference], entities: list[Entity]) -> DataFrame:
    """(ref_table, ref_field, period_month, kind, n_refs): orphan references, as in orphans, for each table, field and month."""
    found = orphans(tables, references, entities)
    return found.groupBy("ref_table", "ref_field", F.date_format("ref_at", "yyyy-MM").alias("period_month"), "kind").agg(F.count(F.lit(1)).alias("n_refs"))

"""Joins on one key with checks that Spark itself doesn't make."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.operators.relops import TableError


def _one(df: DataFrame) -> dict | None:
    row = df.limit(1).collect()
    return row[0].asDict() if row else None


def check_not_many_to_many(left: DataFrame, right: DataFrame, key: str) -> None:
    """An error where a key occurs more than once on both sides. One aggregate of each side, one job."""
    many = [d.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key) for d in (left, right)]
    bad = _one(many[0].join(many[1], key, "left_semi"))
    if bad:
        raise TableError(f"key is repeated on both sides: {bad}")


def checked_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", check: bool = True, null_keys_match: bool = False) -> DataFrame:
    """inner, left, right, outer, or strict: inner after checking that each key of either side has a partner.

    Columns are the left's, then the right's without the key; the key stays at the left's place. A name other than the key on both sides
    is an error, as are keys repeated on both sides. Null keys match nothing, or one another with
    ``null_keys_match``. Empty sides give empty or null-padded rows with all columns.
    """
    if how not in ("inner", "left", "right", "outer", "strict"):
        raise TableError(f"no such join: {how}")
    for d in (left, right):
        if key not in d.columns:
            raise TableError(f"column is missing: {key}")
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise TableError(f"columns on both sides: {sorted(clash)}")
    if check:
        check_not_many_to_many(left, right, key)
    same = (lambda a, b: a.eqNullSafe(b)) if null_keys_match else (lambda a, b: a == b)
    r = right.withColumnRenamed(key, "__key")
    on = same(F.col(key), F.col("__key"))
    if how == "strict":
        for a, b, side in ((left, r, "left"), (r, left, "right")):
            lost = _one(a.join(b, on, "left_anti"))
            if lost:
                raise TableError(f"key of the {side} side without a partner: {lost.get(key, lost.get('__key'))}")
    joined = left.join(r, on, {"strict": "inner", "outer": "full"}.get(how, how))
    k = F.coalesce(key, "__key").alias(key)
    return joined.select(*[k if c == key else F.col(f"`{c}`") for c in left.columns], *[F.col(f"`{c}`") for c in right.columns if c != key])


def rows_with(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the list."""
    return df.join(keys.select(key).distinct(), key, "left_semi").select(*df.columns)


def rows_without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key).distinct(), key, "left_anti").select(*df.columns)


def subset_checked(df: DataFrame, part: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``part``; a key of ``part`` that ``df`` lacks is an error."""
    if check:
        lost = _one(part.select(key).where(F.col(key).isNotNull()).join(df, key, "left_anti"))
        if lost:
            raise TableError(f"key isn't in the table: {lost[key]}")
    return rows_with(df, part, key)


def lookup_preferring(df: DataFrame, genomes: DataFrame, viral: DataFrame) -> DataFrame:
    """Adds ``taxid`` to rows with ``genome_id``: the genome's taxid if viral, else its species if that is, else its taxid.

    ``genomes`` has genome_id (unique), taxid and species_taxid; ``viral`` has taxid. Unknown genomes have null.
    """
    v = viral.select("taxid").distinct()
    g = genomes.select("genome_id", F.col("taxid").alias("own"), "species_taxid")
    g = g.join(v.select(F.col("taxid").alias("own"), F.lit(True).alias("own_viral")), "own", "left")
    g = g.join(v.select(F.col("taxid").alias("species_taxid"), F.lit(True).alias("species_viral")), "species_taxid", "left")
    chosen = F.when(F.col("own_viral"), F.col("own")).when(F.col("species_viral"), F.col("species_taxid")).otherwise(F.col("own"))
    return df.join(g.select("genome_id", chosen.alias("taxid")), "genome_id", "left")

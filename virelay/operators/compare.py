"""Differences between two versions of a table, and its statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, change): ``lost`` keys that only the old table has, ``gained`` ones that only the new has. Null keys don't count."""
    a, b = (d.where(F.col(key).isNotNull()).select(key).distinct() for d in (old, new))
    return a.join(b, key, "left_anti").withColumn("change", F.lit("lost")).unionByName(b.join(a, key, "left_anti").withColumn("change", F.lit("gained")))


def count_deltas(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, n_old, n_new, delta) of each key whose number of rows changed."""
    a, b = (d.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for d, n in ((old, "n_old"), (new, "n_new")))
    both = a.join(b.withColumnRenamed(key, "__k"), F.col(key).eqNullSafe(F.col("__k")), "full")
    return both.select(F.coalesce(key, "__k").alias(key), F.coalesce("n_old", F.lit(0)).alias("n_old"), F.coalesce("n_new", F.lit(0)).alias("n_new")).withColumn("delta", F.col("n_new") - F.col("n_old")).where("delta <> 0")


def transitions(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(old_value, new_value, n) of keys in both tables whose value changed; null is a value."""
    j = old.select(key, F.col(value).alias("old_value")).join(new.select(key, F.col(value).alias("new_value")), key)
    return j.where(~F.col("old_value").eqNullSafe(F.col("new_value"))).groupBy("old_value", "new_value").agg(F.count(F.lit(1)).alias("n"))


def last_reason(reasons: list[tuple[Column, str]], default: str) -> Column:
    """The text of the last condition that holds."""
    out = None
    for condition, text in reversed(reasons):
        out = F.when(condition, text) if out is None else out.when(condition, text)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def metric_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(metric, old, new, delta, pct_change) of two tables (metric, value): percent to two digits, null from 0."""
    j = old.select("metric", F.col("value").alias("old")).join(new.select("metric", F.col("value").alias("new")), "metric", "full")
    j = j.withColumn("delta", F.coalesce("new", F.lit(0)) - F.coalesce("old", F.lit(0)))
    return j.withColumn("pct_change", F.when(F.col("old") != 0, F.round(F.col("delta") / F.col("old") * 100, 2)))


def table_metrics(df: DataFrame) -> DataFrame:
    """(metric, value): rows, and for each column its non-null values, in one pass."""
    parts = [F.count(F.lit(1)).alias("rows")]
    for c in df.columns:
        parts += [F.count(F.col(f"`{c}`")).alias(f"{c}.filled")]
    one = df.agg(*parts)
    names = [p for p in one.columns]
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"`{n}`").cast("double") for n in names]))).alias("metric", "value"))

"""Results for each key when a handful of keys holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from virelay.session import cut_lineage

#: Doubles are summed apart for each band of so many powers of two, as whole multiples of the band's smallest step. 53 bits make a double.
_BAND, _MANTISSA, _LEAST = 32, 53, -1074


def key_counts(df: DataFrame, key: str, count_as: str = "n_rows") -> DataFrame:
    """Rows of each key, null keys left out.

    Spark counts inside each task first, in a hash table of bounded size that sorts and spills when it
    is full; only one partial count for each key and task crosses the network. So no task gets the rows
    of a hot key, however hot. Empty input gives no rows.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_as))


def _unit(band: Column) -> Column:
    return F.pow(F.lit(2.0), F.greatest(band * _BAND - _MANTISSA, F.lit(_LEAST)))


def key_summary(df: DataFrame, key: str, member: str, value: str) -> DataFrame:
    """One row for each key: key, n_rows, n_members, n_values, mean_value, min_value, max_value.

    Counts, sums, minima and maxima are small states that merge: they are combined in the tasks, and only they shuffle. Sums
    don't depend on the order of rows and lose no value: each is a whole multiple of the smallest step of its band of magnitudes, and such
    multiples are added exactly, band by band, as decimals; a key has a row for each band its values fall into, mostly one. Bands are added up
    from the smallest. The mean is rounded to 6 digits; minimum and maximum are as they stand.

    ``n_members`` counts distinct non-null members. That has no small mergeable state, so distinct pairs of key and member, two slim columns, are spread by
    hash of both over all tasks and counted; the few counts are joined to the keys. Null keys are no keys; null values and NaN count as rows but not
    as values, an infinite one makes the mean infinite (or NaN with both signs); a key with null values only has null mean, minimum and maximum. Repeated rows all count.
    """
    kind = dict(df.dtypes)[value]
    real = kind in ("double", "float")
    rows = df.where(F.col(key).isNotNull())
    v = F.when(~F.isnan(value), F.col(value)).cast("double") if real else F.col(value)
    size, high = F.abs("__v"), F.lit(2.0**_BAND)
    if real:
        band = F.when((size > 0) & (size < float("inf")), F.floor(F.log2(size) / _BAND)).otherwise(0).cast("int")
        steps = F.when(size < float("inf"), F.col("__v") / _unit(F.col("__b")))
        # a multiple has up to 85 bits: its upper part and its lower 32 are whole numbers that a bigint holds
        upper = F.floor(steps / high)
        sums = [F.sum(x.cast("bigint").cast("decimal(20,0)")) for x in (upper, steps - upper * high)]
        total = (F.col("s").cast("double") * high + F.col("low").cast("double")) * _unit(F.col("__b"))
    else:
        band = F.lit(0)
        sums = [F.sum(F.col("__v") if kind.startswith("decimal") else F.col("__v").cast("decimal(20,0)")), F.lit(0)]
        total = F.col("s").cast("double")
    part = (
        rows.select(F.col(key).alias("__k"), v.alias("__v")).withColumn("__b", band).groupBy("__k", "__b")
        .agg(F.count(F.lit(1)).alias("r"), F.count("__v").alias("c"), sums[0].alias("s"), sums[1].alias("low"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    )
    summed = F.aggregate(F.sort_array(F.collect_list(F.struct("__b", total.alias("t")))), F.lit(0.0), lambda acc, x: acc + F.coalesce(x["t"], F.lit(0.0)))
    if real:
        endless = [F.when(m == x, F.lit(x)).otherwise(0.0) for m, x in ((F.max("hi"), float("inf")), (F.min("lo"), -float("inf")))]
        summed = summed + endless[0] + endless[1]
    merged = part.groupBy("__k").agg(F.sum("r").alias("n_rows"), F.sum("c").alias("n_values"), summed.alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    pairs = rows.where(F.col(member).isNotNull()).select(F.col(key).alias("__m"), F.col(member).alias("m")).distinct()
    members = pairs.groupBy("__m").agg(F.count(F.lit(1)).alias("n_members"))
    return merged.join(members, F.col("__k") == F.col("__m"), "left").select(
        F.col("__k").alias(key), "n_rows", F.coalesce("n_members", F.lit(0).cast("bigint")).alias("n_members"), "n_values",
        F.round(F.when(F.col("n_values") > 0, F.col("s") / F.col("n_values")), 6).alias("mean_value"),
        F.col("lo").cast("double").alias("min_value"), F.col("hi").cast("double").alias("max_value"),
    )


def heavy_keys(df: DataFrame, key: str, least_percent: int) -> DataFrame:
    """Keys that hold at least ``least_percent`` of all rows: key, n_rows, n_total.

    Rows with a null key belong to the total. The comparison is in whole numbers, so it is exact. Empty input
    gives no rows. The table is read once: the counts, a row for each key, are checkpointed, and the total is their sum.
    """
    counts = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")))
    total = counts.agg(F.sum("n_rows").alias("n")).scalar()
    return counts.where(F.col(key).isNotNull()).withColumn("n_total", total).where(F.col("n_rows") * 100 >= F.col("n_total") * least_percent)

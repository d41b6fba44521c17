"""Relational operators with the checks that a pipeline of tables needs.

Checks that look at rows are eager: they run a job when the operator is called, and each can be turned off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virelay.session import cut_lineage


class TableError(ValueError):
    """A table isn't what an operator needs."""


def _need(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise TableError(f"columns are missing: {', '.join(missing)}")


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns in the order asked for; a missing one is an error."""
    _need(df, columns)
    return df.select(*[F.col(f"`{c}`") for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without the columns; missing ones are passed over; dropping all is an error."""
    if not set(df.columns) - set(columns):
        raise TableError("no column would be left")
    return df.drop(*columns)


def rename_columns(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Renames at once, so swaps are safe; lists of unequal length or a missing column are errors."""
    if len(old) != len(new):
        raise TableError("as many new names as old ones are needed")
    _need(df, old)
    names = dict(zip(old, new, strict=True))
    out = [names.get(c, c) for c in df.columns]
    if len(set(out)) < len(out):
        raise TableError("two columns would have one name")
    return df.toDF(*out)


def add_header(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise TableError(f"{len(df.columns)} names are needed, not {len(names)}")
    return df.toDF(*names)


def add_fixed_columns(df: DataFrame, names: Sequence[str], value: object) -> DataFrame:
    """New columns with one value; a name that exists is an error."""
    clash = [c for c in names if c in df.columns]
    if clash:
        raise TableError(f"columns exist: {', '.join(clash)}")
    return df.withColumns({c: F.lit(value) for c in names})


def add_conditional_column(df: DataFrame, new: str, check: str, match: object, if_column: str, else_column: str) -> DataFrame:
    """``if_column`` where ``check`` equals ``match``, else ``else_column``. A null ``match`` matches null."""
    _need(df, [check, if_column, else_column])
    return df.withColumn(new, F.when(F.col(check).eqNullSafe(F.lit(match)), F.col(if_column)).otherwise(F.col(else_column)))


def prefix_columns(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return rename_columns(df, columns, [prefix + c for c in columns])


def pad_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Null columns of the given types for those that the table lacks."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


def _coerced(value: str) -> int | float | str:
    """A text as a truth value (1 or 0), else a whole number, else a number, else itself."""
    if value.lower() in ("true", "false"):
        return int(value.lower() == "true")
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return value


def coerced_equal(c: Column, value: str) -> Column:
    """Whether a text cell equals a text value once both are read as truth values, else whole numbers, else numbers, else text.

    Whole numbers of any size compare exactly, also with numbers written with a point or an exponent; NaN equals nothing.
    """
    c, want = c.cast("string"), _coerced(value)
    if isinstance(want, str):
        return c == value
    if isinstance(want, float) and not want.is_integer():
        whole = F.lit(False)
    else:
        digits = F.regexp_replace(F.regexp_replace(F.trim(c, F.lit(" \t\r\n")), "_", ""), r"^([+-]?)0+(?=\d)", "$1")
        whole = F.regexp_replace(digits, r"^\+|^-(?=0$)", "") == str(int(want))
    try:
        as_double = float(want)
    except OverflowError:
        as_double = None
    exact = as_double is not None and as_double == want  # else no number with a point equals it
    real = F.regexp_replace(F.trim(c, F.lit(" \t\r\n")), "_", "").try_cast("double") == as_double if exact else F.lit(False)
    truth = F.lower(c)
    return (
        F.when(truth.isin("true", "false"), F.lit(want in (0, 1)) & (truth == ("true" if want == 1 else "false")))
        .when(c.rlike(r"^\s*[+-]?\d+(?:_\d+)*\s*$"), whole)
        .when(c.rlike(r"(?i)^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+)?|inf|infinity)\s*$"), real)
        .when(c.isNotNull(), F.lit(False))
    )


def filter_by_value(df: DataFrame, column: str, value: str, keep: bool = True) -> DataFrame:
    """Rows whose cell equals the value by coerced_equal, or the others. Null equals nothing, so it stays among the others."""
    _need(df, [column])
    same = F.coalesce(coerced_equal(F.col(column), value), F.lit(False))
    return df.where(same if keep else ~same)


def assert_unique(df: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """The table itself; an error names a key that occurs twice."""
    _need(df, keys)
    if check:
        twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
        if twice:
            raise TableError(f"key occurs {twice[0]['count']} times: {twice[0].asDict()}")
    return df


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``, which should leave no ties.

    Rows are reduced in the tasks before they shuffle: the least of a struct that begins with the order, so a hot key
    costs one row for each task. Descending numbers are given by negated columns. Null keys are a key.
    """
    _need(df, keys)
    rest = [c for c in df.columns if c not in keys]
    parts = [c.alias(f"o{i}") for i, c in enumerate(order)] + [F.col(f"`{c}`") for c in rest]
    first = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(F.struct(*parts)).alias("__first"))
    return first.select(*[F.col(f"`{k}`") if k in keys else F.col(f"__first.`{k}`").alias(k) for k in df.columns])


def rank_fraction_filter(df: DataFrame, group: str, score: str, max_rank: int, min_fraction: float) -> DataFrame:
    """Rows within ``max_rank`` dense ranks of score and at least ``min_fraction`` of the group's best; adds rank and fraction.

    The group's distinct scores are aggregated first, so the ranks are computed over those, not over rows. The first rank
    always stays. Rows with a null score are dropped.
    """
    scores = df.where(F.col(score).isNotNull()).groupBy(group, score).agg(F.lit(1).alias("__one"))
    w = Window.partitionBy(group).orderBy(F.col(score).desc())
    ranked = scores.select(group, score, F.dense_rank().over(w).alias("rank"), F.first(score).over(w).alias("__best"))
    ranked = ranked.withColumn("fraction", F.when(F.col("rank") == 1, 1.0).otherwise(F.col(score) / F.col("__best")))
    kept = ranked.where((F.col("rank") <= max_rank) & ((F.col("rank") == 1) | (F.col("fraction") >= min_fraction)))
    other = [c for c in df.columns if c not in (group, score)]
    return df.join(kept.select(F.col(group).alias("__g"), F.col(score).alias("__s"), "rank", "fraction"), F.col(group).eqNullSafe(F.col("__g")) & (F.col(score) == F.col("__s"))).select(group, score, *other, "rank", "fraction")


def union_by_header(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns by name in the order of the first table; unequal sets of names are an error."""
    if not tables:
        raise TableError("no table")
    out = tables[0]
    for t in tables[1:]:
        if set(t.columns) != set(out.columns):
            raise TableError(f"unequal headers: {sorted(set(t.columns) ^ set(out.columns))}")
        out = out.unionByName(t)
    return out


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks; null counts as a key."""
    return a.select(key).distinct().subtract(b.select(key))


def top_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows; Spark keeps n rows for each task and merges those."""
    return df.orderBy(*order).limit(n)


def chunk_rows(df: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    """Adds ``chunk``, 1 for the first ``size`` rows by ``order``, and so on.

    Rows are sorted by ranges; only the counts of the partitions go to the driver, so no task sees all rows.
    """
    if size < 1:
        raise TableError("a chunk needs a size of at least 1")
    sorted_ = df.orderBy(*order).withColumn("__part", F.spark_partition_id())
    sorted_ = cut_lineage(sorted_)
    counts = sorted(sorted_.groupBy("__part").count().collect())
    before, rows = 0, []
    for part, n in counts:
        rows.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(rows or [(0, 0)], "__part int, __before long")
    w = Window.partitionBy("__part").orderBy(*order)
    numbered = sorted_.withColumn("__n", F.row_number().over(w)).join(F.broadcast(offsets), "__part")
    return numbered.withColumn("chunk", (F.floor((F.col("__before") + F.col("__n") - 1) / size) + 1).cast("bigint")).select(*df.columns, "chunk")


def sample_by_key(df: DataFrame, key: str, share: float, seed: int = 17310) -> DataFrame:
    """Rows whose key hashes below ``share``: all rows of a key or none, the same at every run. Null keys are left out unless all stay."""
    if not 0 <= share <= 1:
        raise TableError("a share lies between 0 and 1")
    if share == 1:
        return df
    return df.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))))


def sample_to_target(df: DataFrame, key: str, target: int, seed: int = 17310) -> DataFrame:
    """About ``target`` keys: each with the chance of target over distinct keys; all if there are no more."""
    n = df.select(key).where(F.col(key).isNotNull()).distinct().count()
    return df if n <= target else sample_by_key(df, key, target / n, seed)

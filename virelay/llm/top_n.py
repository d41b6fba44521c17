"""The N best items of every group, by a secondary sort and a stream over it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first_n(n: int, ranked: bool):
    """A stream over batches sorted by their first column: the first ``n`` rows of each run, and their rank if asked.

    Between batches only the last group and how many of its rows came so far are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(0)
            new = np.ones(b.num_rows, bool)
            new[1:] = pc.not_equal(g[1:], g[:-1]).to_numpy(zero_copy_only=False)
            carried = seen if g[0].as_py() == last and last is not None else 0
            at = np.arange(b.num_rows)
            begin = np.maximum.accumulate(np.where(new, at, 0))
            rank = at - begin + 1 + np.where(begin == 0, carried, 0)
            last, seen = g[-1].as_py(), int(rank[-1])
            keep = np.flatnonzero(rank <= n)
            out = b.take(pa.array(keep))
            if ranked:
                out = pa.RecordBatch.from_arrays([*out.columns, pa.array(rank[keep].astype(np.int32))], [*out.schema.names, "rank_no"])
            yield out

    return run


def top_n(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """(group, rank_no, item, score): for each group its ``n`` best distinct items, best first.

    An item's score in a group is its highest; equal scores rank the smaller item first. Rows with a null group, item or
    score don't count. Repeated rows change nothing; fewer items give fewer ranks; empty input gives no rows. Only the three columns
    are read.

    Items are first combined for each (group, item), in the tasks and then by hash of both, which spreads a hot group over all
    partitions. Each such partition is sorted by group, score and item and streamed, passing at most ``n`` rows of each group;
    so the second hash partitioning, by group, meets at most ``n`` rows for each group and partition, however many the group has.
    It is sorted and streamed again. No group is ever held.
    """
    kinds = dict(df.dtypes)
    row = df.select(F.col(group).alias("g"), F.col(item).alias("i"), F.col(score).alias("s"))
    best = row.dropna().groupBy("g", "i").agg(F.max("s").alias("s"))
    order = [F.col("g"), F.col("s").desc(), F.col("i")]
    schema = f"g {kinds[group]}, i {kinds[item]}, s {kinds[score]}"
    near = best.sortWithinPartitions(*order).mapInArrow(_first_n(n, False), schema)
    final = near.repartition("g").sortWithinPartitions(*order).mapInArrow(_first_n(n, True), schema + ", rank_no int")
    return final.select(F.col("g").alias(group), "rank_no", F.col("i").alias(item), F.col("s").alias(score))

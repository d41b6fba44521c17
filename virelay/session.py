"""What all jobs share: tables, checkpoints, sizes of small sides."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only up to this many bytes; beyond it Spark plans the join itself.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir, or else the context, names, which all executors share.

    Only where neither does, as in tests in one process, a new one is taken.
    """
    set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or (set_dir.get() if set_dir.isDefined() else None)
    if not folder:
        if not re.fullmatch(r"local(\[[^,]*(,[^,]*)?\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def counted_cut(df: DataFrame, count: Column | None = None) -> tuple[DataFrame, int]:
    """``df`` by cut_lineage, and how many rows it has, or for how many ``count`` is true, found in the same job."""
    seen = Observation()
    kept = cut_lineage(df.observe(seen, (F.count(F.lit(1)) if count is None else F.count_if(count)).alias("n")))
    return kept, seen.get["n"]


def spread_scan(df: DataFrame) -> DataFrame:
    """A table as it is read, over as many tasks as run at once where its files give fewer, as small ones do; large tables stay as they are."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def broadcast_if_small(df: DataFrame, n_bytes: int | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast for a side whose counted bytes (null: none) are within ``limit``."""
    return F.broadcast(df) if (n_bytes or 0) <= limit else df


def array_bytes(df: DataFrame, column: str) -> int | None:
    """About how many bytes the rows of ``df`` take whose bulk is an array of numbers of 8 bytes."""
    return df.agg(F.sum(F.greatest(F.size(column), F.lit(0)) * 8 + 64)).first()[0]

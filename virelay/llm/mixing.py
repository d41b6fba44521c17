"""Mixtures of sources by target shares, with pivotal dependent rounding of the copies."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.session import broadcast_if_small, cut_lineage

#: Documents of one bucket of the first level, and residuals of one bucket above.
BUCKET_ROWS, FAN_IN = 50_000, 1_000


def pivot(p: np.ndarray, w: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after pairwise transfers: all 0 or 1 but for at most one.

    A pair exchanges size (probability times weight) until one of it is 0 or 1; the direction is drawn so that every
    probability keeps its expectation, and the sum of p * w stays as it is. Weights must be above 0.
    """
    p = p.astype(float).copy()
    while True:
        open_ = np.flatnonzero((p > 0) & (p < 1))
        if len(open_) < 2:
            return p
        open_ = open_[: len(open_) // 2 * 2].reshape(-1, 2)
        i, j = open_[:, 0], open_[:, 1]
        have_i, have_j, room_i, room_j = p[i] * w[i], p[j] * w[j], (1 - p[i]) * w[i], (1 - p[j]) * w[j]
        to_j, to_i = np.minimum(have_i, room_j), np.minimum(have_j, room_i)
        up = rng.random(len(i)) * (to_i + to_j) < to_i  # with this chance size goes from i to j
        give, take = np.where(up, i, j), np.where(up, j, i)
        have, room = np.where(up, have_i, have_j), np.where(up, room_j, room_i)
        empties = have <= room
        t = np.where(empties, have, room)
        p[give] = np.where(empties, 0.0, np.clip(p[give] - t / w[give], 0, 1))
        p[take] = np.where(empties, np.clip(p[take] + t / w[take], 0, 1), 1.0)


def source_rates(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, max_repeats, wanted, n_docs, n_tokens, rate) of each target.

    ``rate`` is the uses of an average document: wanted tokens over the source's tokens, at most ``max_repeats``. A source without tokens has
    rate 0. Repeated target rows count once; a null share or budget wants nothing; a negative cap is 0.
    """
    one = targets.where(F.col("mix_id").isNotNull() & F.col("source").isNotNull()).groupBy("mix_id", "source").agg(
        F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"), F.max("budget_ratio").alias("budget_ratio")
    )
    total = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("corpus")).withColumn("__one", F.lit(1))
    by_source = sizes.where(F.col("source").isNotNull())
    wanted = F.coalesce(F.col("target_share") * F.col("budget_ratio") * F.col("corpus"), F.lit(0.0))
    rate = F.when(F.col("n_tokens") > 0, F.col("wanted") / F.col("n_tokens")).otherwise(F.lit(0.0))
    return (
        one.join(by_source, "source", "left").withColumn("__one", F.lit(1)).join(F.broadcast(total), "__one")
        .withColumn("wanted", wanted)
        .select(
            "mix_id", "source", "target_share", "max_repeats", "wanted",
            F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
            F.greatest(F.lit(0.0), F.least(rate, F.col("max_repeats").cast("double"))).alias("rate"),
        )
    )


def mix(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", seed: int = 29, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """Uses (mix_id, doc_id, source, n_tokens, n_uses) of each document of a mix's sources, and the shares reached.

    ``docs`` has doc_id, source and n_tokens. Wanted tokens of a source are target_share * budget_ratio * tokens of the whole corpus.
    Each document is used floor(rate) times, and once more with the fractional rest as probability, by pivotal rounding: the tokens of a
    source come out within one document of what its rate says, without a bias for or against any document. A source that can't give
    its share within max_repeats gives what it can; other sources don't make up for it. Documents without tokens have no size and no
    uses. Documents of a null source belong to the corpus, not to any mix. Results don't depend on the order of rows.

    Only documents with tokens and a fractional rest are rounded; all others are settled at once. Those of a (mix, source) are spread over
    buckets of about ``bucket_rows``, counted from just them; each bucket rounds its own in a task and
    leaves one residual at most; residuals are rounded by ``fan_in`` buckets together, level by level, so no task ever gets
    all documents of a large source.

    Shares: (mix_id, source, target_share, max_repeats, n_docs, source_tokens, wanted_tokens, used_tokens, used_share), the share of
    all used tokens of the mix; sources without documents have 0.
    """
    docs = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), "source", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")))
    sizes = docs.groupBy("source").agg(F.count_if(F.col("n_tokens") > 0).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    rates = cut_lineage(source_rates(sizes, targets))
    fraction = F.col("rate") - F.floor("rate")
    known = rates.agg(F.sum(F.octet_length("mix_id") + F.octet_length("source") + 64).alias("bytes"), F.max(F.when(fraction > 0, F.col("n_docs"))).alias("most")).first()
    buckets = max(1, math.ceil((known.most or 0) / bucket_rows))
    use = rates.select("mix_id", "source", "rate", F.ceil(F.greatest(F.lit(1), "n_docs") / bucket_rows).cast("int").alias("buckets"))
    every = docs.join(broadcast_if_small(use, known.bytes), "source").select(
        "mix_id", "source", "doc_id", "n_tokens",
        F.when(F.col("n_tokens") > 0, F.floor("rate")).otherwise(F.lit(0)).cast("int").alias("base"),
        F.when(F.col("n_tokens") > 0, fraction).otherwise(F.lit(0.0)).alias("p"),
        F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("buckets")).cast("int").alias("bucket"),
    )
    schema = "mix_id string, source string, doc_id " + dict(docs.dtypes)["doc_id"] + ", n_tokens bigint, base int, p double, bucket int"

    def rounder(level: int):
        def run(f: pd.DataFrame) -> pd.DataFrame:
            f = f.sort_values(["doc_id", "n_tokens"], kind="stable").reset_index(drop=True)
            key = f"{f['mix_id'][0]}\x00{f['source'][0]}\x00{f['bucket'][0]}\x00{level}\x00{seed}"
            rng = np.random.default_rng(zlib.crc32(key.encode()))
            order = rng.permutation(len(f))
            f = f.iloc[order].reset_index(drop=True)
            return f.assign(p=pivot(f["p"].to_numpy(float), f["n_tokens"].to_numpy(float), rng))

        return run

    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    state, settled, level = every.where(fractional), every.where(~fractional), 0
    while True:
        state = cut_lineage(state.groupBy("mix_id", "source", "bucket").applyInPandas(rounder(level), schema))
        settled = settled.unionByName(state.where(~fractional))
        if buckets == 1:
            break
        level, buckets = level + 1, math.ceil(buckets / fan_in)
        state = state.where(fractional).withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("int"))
    drawn = (F.pmod(F.xxhash64("mix_id", "source", "doc_id", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.col("p")).cast("double")
    last = state.where(fractional).withColumn("p", drawn)
    uses = settled.unionByName(last).select("mix_id", "doc_id", "source", "n_tokens", (F.col("base") + F.col("p").cast("int")).alias("n_uses"))
    used = uses.groupBy("mix_id", "source").agg(F.sum(F.col("n_uses") * F.col("n_tokens")).alias("used"))
    shares = rates.join(used, ["mix_id", "source"], "left").withColumn("used", F.coalesce("used", F.lit(0)))
    per_mix = shares.groupBy("mix_id").agg(F.sum("used").alias("mix_used"))
    shares = shares.join(per_mix, "mix_id").select(
        "mix_id", "source", "target_share", "max_repeats", "n_docs", F.col("n_tokens").alias("source_tokens"),
        F.round("wanted", 3).alias("wanted_tokens"), F.col("used").alias("used_tokens"),
        F.when(F.col("mix_used") > 0, F.round(F.col("used") / F.col("mix_used"), 6)).otherwise(F.lit(0.0)).alias("used_share"),
    )
    return uses, shares

"""Reads: counts, quality tables, screens by k-mers, merging of mates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.functions import seq as sq
from virelay.operators.relops import distinct_on


def read_counts(reads: DataFrame, sample: str, paired: bool) -> DataFrame:
    """(sample, n_reads_single, n_read_pairs) of rows that are single reads or pairs; pairs are null for single reads."""
    n = reads.groupBy(F.col(sample).alias("sample")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("sample", (F.col("n") * (2 if paired else 1)).alias("n_reads_single"), (F.col("n") if paired else F.lit(None).cast("bigint")).alias("n_read_pairs"))


def basic_stats(reads: DataFrame, sample: str, seq: str) -> DataFrame:
    """For each sample: n_reads, n_bases, mean_seq_len, percent_gc, percent_duplicates (reads whose sequence came before), n_distinct.

    Sequences are combined for each (sample, sequence) first, which spreads a large sample. Null sequences don't count.
    """
    r = reads.where(F.col(seq).isNotNull()).select(F.col(sample).alias("sample"), F.upper(seq).alias("s"))
    each = r.groupBy("sample", "s").agg(F.count(F.lit(1)).alias("n"))
    gc = F.length(F.regexp_replace("s", "[^GC]", ""))
    t = each.groupBy("sample").agg(F.sum("n").alias("n_reads"), F.count(F.lit(1)).alias("n_distinct"), F.sum(F.length("s") * F.col("n")).alias("n_bases"), F.sum(gc * F.col("n")).alias("gc"))
    return t.select(
        "sample", "n_reads", "n_bases", F.round(F.col("n_bases") / F.col("n_reads"), 4).alias("mean_seq_len"),
        F.when(F.col("n_bases") > 0, F.round(F.col("gc") * 100 / F.col("n_bases"), 4)).alias("percent_gc"),
        F.round((F.col("n_reads") - F.col("n_distinct")) * 100 / F.col("n_reads"), 4).alias("percent_duplicates"), "n_distinct",
    )


def length_stats(reads: DataFrame, sample: str, seq: str) -> DataFrame:
    """(sample, length, n_sequences)."""
    return reads.where(F.col(seq).isNotNull()).groupBy(F.col(sample).alias("sample"), F.length(seq).alias("length")).agg(F.count(F.lit(1)).alias("n_sequences"))


def quality_by_base(reads: DataFrame, sample: str, qual: str) -> DataFrame:
    """(sample, position, mean_phred_score), positions from 1."""
    scores = reads.where(F.col(qual).isNotNull()).select(F.col(sample).alias("sample"), F.posexplode(sq.phred_scores(F.col(qual))).alias("p", "q"))
    return scores.groupBy("sample", (F.col("p") + 1).alias("position")).agg(F.round(F.avg("q"), 4).alias("mean_phred_score"))


def quality_by_sequence(reads: DataFrame, sample: str, qual: str) -> DataFrame:
    """(sample, mean_phred_score, n_sequences): reads of each mean score, rounded down to whole numbers."""
    m = F.floor(sq.mean_phred(F.col(qual)))
    return reads.where(F.col(qual).isNotNull()).groupBy(F.col(sample).alias("sample"), m.alias("mean_phred_score")).agg(F.count(F.lit(1)).alias("n_sequences"))


def joined_flags(stats: DataFrame, key: str, column: str, order: str) -> DataFrame:
    """The key's values of a text column, joined by ``/`` in ``order``: for few rows for each key, as the files of a sample."""
    return stats.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, column))), lambda x: x[column]), "/").alias(column))


def packed_kmers(df: DataFrame, keep: list[str], seq: str, k: int) -> DataFrame:
    """The columns ``keep`` and ``kmers array<bigint>``: the distinct canonical k-mers of A, C, G and T in each sequence, two bits a base, in order.

    A canonical k-mer is the smaller of itself and its reverse complement, case aside; as numbers they are ordered as their texts. ``k`` is 31 at most. A null sequence
    has null, a short one none. Both strands of a whole batch are packed together, base by base.
    """
    if not 0 < k <= 31:
        raise ValueError("k must be between 1 and 31")
    of_byte = np.full(256, 4, np.uint8)
    for i, pair in enumerate((b"Aa", b"Cc", b"Gg", b"Tt")):
        of_byte[list(pair)] = i

    def pack(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
        base, offsets = of_byte[data], offsets - offsets[0]
        n = max(len(base) - k + 1, 0)
        there, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(k):
            b = base[i : i + n].astype(np.int64)
            there, back = (there << 2) | (b & 3), back | ((3 - (b & 3)) << (2 * i))
        row = np.repeat(np.arange(len(texts)), np.diff(offsets))[:n]
        bad = np.r_[0, np.cumsum(base > 3)]
        at = np.flatnonzero((bad[k : k + n] == bad[:n]) & (np.arange(n) + k <= offsets[1:][row] if n else np.zeros(0, bool)))
        row, code = row[at], np.minimum(there, back)[at]
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        size = np.bincount(row[new], minlength=len(texts))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(code[new]))
        return pc.if_else(texts.is_valid(), lists, pa.scalar(None, lists.type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pack(b.column(b.num_columns - 1))], [*keep, "kmers"])

    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(*keep).dtypes)
    return df.select(*keep, F.col(seq).alias("__seq")).mapInArrow(run, f"{fields}{', ' if keep else ''}kmers array<bigint>")


def kmer_index(genomes: DataFrame, name: str, seq: str, k: int) -> DataFrame:
    """(kmer bigint): distinct canonical k-mers of all sequences, packed."""
    return packed_kmers(genomes, [], seq, k).select(F.explode("kmers").alias("kmer")).distinct()


def kmer_screen(reads: DataFrame, read: str, seq: str, index: DataFrame, k: int, min_hits: int = 1, min_fraction: float = 0.0) -> DataFrame:
    """(read, n_kmers, n_hits, matched): how many of a read's distinct canonical k-mers the index of kmer_index holds.

    K-mers shuffle to the index as numbers; it is never broadcast by this operator. Hits are combined by read in the tasks and joined to the reads' counts,
    so a k-mer that isn't in the index costs nothing beyond the join.
    """
    words = packed_kmers(reads.select(F.col(read).alias("read"), F.col(seq).alias("seq")), ["read"], "seq", k)
    hits = words.select("read", F.explode("kmers").alias("kmer")).join(index.select("kmer"), "kmer", "left_semi").groupBy("read").agg(F.count(F.lit(1)).alias("n_hits"))
    n = F.size("kmers")
    counts = words.groupBy("read").agg(F.max(n).alias("n_kmers")).join(hits, "read", "left").withColumn("n_hits", F.coalesce("n_hits", F.lit(0).cast("bigint")))
    ok = (F.col("n_hits") >= min_hits) & (F.col("n_hits") >= F.col("n_kmers") * min_fraction) & (F.col("n_hits") > 0)
    return counts.select(F.col("read").alias(read), "n_kmers", "n_hits", ok.alias("matched"))


def mask_lower(seq_column):
    """Lower-case bases as x."""
    return F.regexp_replace(seq_column, "[acgtn]", "x")


def genome_metadata(fasta: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata rows (accession, taxid, species_taxid, ...) with a row for each sequence of their file.

    ``fasta`` has file and genome_id. The accession is the file name's first part; of several files of an accession the first by name counts;
    files without an accession, or one that the metadata lacks, are dropped.
    """
    acc = F.regexp_extract(F.regexp_extract("file", r"([^/]+)$", 1), r"^(GC[AF]_\d+\.\d+)", 1)
    f = fasta.withColumn("accession", acc).where("accession <> ''")
    first = f.groupBy("accession").agg(F.min("file").alias("file"))
    return metadata.join(f.select("accession", "file", "genome_id").join(first, ["accession", "file"]), "accession")


def screen_genomes(metadata: DataFrame, infecting: DataFrame, assembly_status: str = "current") -> DataFrame:
    """Genomes of the status whose taxid or species is among the infecting taxids."""
    keep = infecting.select(F.col("taxid").alias("__t")).distinct()
    cur = metadata.where(F.col("assembly_status") == assembly_status)
    long = cur.select("*", F.explode(F.array_distinct(F.array("taxid", "species_taxid"))).alias("__t"))
    hit = long.join(keep, "__t", "left_semi").drop("__t")
    return hit.dropDuplicates()


def without_headers_like(fasta: DataFrame, header: str, patterns: list[str]) -> DataFrame:
    """Sequences whose header has none of the patterns, in any case; a null header stays."""
    bad = F.col(header).rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)
    return fasta.where(~F.coalesce(bad, F.lit(False)))


def between_lengths(reads: DataFrame, seq: str, shortest: int, longest: int, qual: str | None = None, least_quality: float = 0.0) -> DataFrame:
    """Reads within the lengths and, with qualities, of at least the mean quality."""
    kept = reads.where(F.length(seq).between(shortest, longest))
    return kept if qual is None else kept.where(sq.mean_phred(F.col(qual)) >= least_quality)


def first_by_name(fasta: DataFrame, name: str, order: list[str]) -> DataFrame:
    """One sequence of each name, the first by ``order``."""
    return distinct_on(fasta, [name], [F.col(c) for c in order])


def interleaved(pairs: DataFrame) -> DataFrame:
    """(seq_id, mate, seq, qual): two rows for each pair of pair_mates."""
    mates = F.array(F.struct(F.lit(1).alias("mate"), "seq", "qual"), F.struct(F.lit(2).alias("mate"), F.col("seq_rev").alias("seq"), F.col("qual_rev").alias("qual")))
    return pairs.select("seq_id", F.explode(mates).alias("m")).select("seq_id", "m.*")

"""Column expressions on reads, qualities, flags and scores; all but the entropy run inside the JVM."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complements of the IUPAC codes (fixed values).
_BASES, _COMPLEMENTS = "ACGTUNRYSWKMBDHVacgtunryswkmbdhv", "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"
#: Flag bits of SAM (fixed values).
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, READ1, READ2, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = (1 << i for i in range(12))


def reverse_complement(seq: Column) -> Column:
    """Reverse complement with IUPAC codes of both cases; other characters stay. Null gives null."""
    return F.translate(F.reverse(seq), _BASES, _COMPLEMENTS)


def phred_scores(qual: Column) -> Column:
    """Phred+33 scores as an array; empty for an empty string."""
    return F.transform(F.filter(F.split(qual, ""), lambda x: x != ""), lambda x: F.ascii(x) - 33)


def mean_phred(qual: Column) -> Column:
    """Mean Phred+33 score; 0 for a null or empty string, as an absent mate counts."""
    total = F.aggregate(phred_scores(qual), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(qual) > 0, total / F.length(qual)).otherwise(F.lit(0.0))


def flag_set(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def mate_flag(flag: Column) -> Column:
    """The flag of an unmapped mate made up for a mapped read: other end, unmapped, mate mapped."""
    swapped = flag.bitwiseXOR(F.lit(READ1 | READ2)).bitwiseOR(F.lit(UNMAPPED))
    return swapped.bitwiseAND(F.lit(~MATE_UNMAPPED & 0xFFFF))


def pair_score(score: Column, seq: Column) -> Column:
    """Score over the log of the length; 0 without a score or a sequence. A length of 1 gives 0."""
    n = F.length(seq)
    return F.when(score.isNull() | seq.isNull() | (n <= 1), F.lit(0.0)).otherwise(score / F.ln(n))


def long_read_score(score: Column, length: Column) -> Column:
    """Score over the log of the length; 0 for lengths up to 1."""
    return F.when(length <= 1, F.lit(0.0)).otherwise(score / F.ln(length))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in upper case, in order; none where the sequence is shorter. Null gives null."""

    def all_of(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: F.substring(s, i, F.lit(k)))

    # the upper-case text is bound to a variable, else each k-mer would make it anew
    words = F.get(F.transform(F.array(F.upper(seq)), all_of), F.lit(0))
    return F.when(F.length(seq) >= k, words).when(seq.isNotNull(), F.array().cast("array<string>"))


def canonical_kmers(seq: Column, k: int) -> Column:
    """Distinct k-mers of A, C, G and T, each as the smaller of itself and its reverse complement."""
    clean = F.filter(kmers(seq, k), lambda x: ~x.rlike("[^ACGT]"))
    return F.array_distinct(F.transform(clean, lambda x: F.least(x, reverse_complement(x))))


def linguistic_entropy(seq: Column, k: int = 3) -> Column:
    """Shannon entropy of the k-mers over its maximum for the length, 0 to 1; null for sequences shorter than k + 1.

    Counts within a row have no built-in aggregate, so a batch's k-mers are counted together in numpy.
    """

    @F.pandas_udf("double")
    def entropy(texts: pd.Series) -> pd.Series:
        data = [(t or "").upper().encode("latin-1", "replace") for t in texts]
        size = np.array([len(d) for d in data], np.int64)
        b = np.frombuffer(b"".join(data), np.uint8).astype(np.int64)
        n = np.maximum(size - k + 1, 0)
        first = np.repeat(np.cumsum(size) - size, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row = np.repeat(np.arange(len(data)), n)
        code = row.copy()
        for i in range(k):
            code = (code << 8) | b[first + i]
        _, at, count = np.unique(code, return_index=True, return_counts=True)
        runs = np.bincount(row[at], weights=count * np.log2(count), minlength=len(data))
        ok = n >= 2
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (np.log2(n) - runs / n) / np.log2(np.minimum(n, 4**k))
        return pd.Series(np.where(ok, out, np.nan)).where(ok, None)

    return entropy(seq)


def join_mates(fwd: Column, rev: Column) -> Column:
    """Forward read, one N, reverse complement of the mate."""
    return F.concat(fwd, F.lit("N"), reverse_complement(rev))


def join_mate_quals(fwd: Column, rev: Column) -> Column:
    return F.concat(fwd, F.lit("!"), F.reverse(rev))


def header_with_suffix(header: Column, suffix: str) -> Column:
    """``::suffix`` put behind the first word of a header."""
    return F.regexp_replace(header, r"^(\S+)", f"$1::{suffix}")


def base_pairs(text: Column) -> Column:
    """'1.5 Gbp' and the like as a number of bases; null where it can't be read."""
    unit = F.lower(F.regexp_extract(text, r"([kKmMgG]?)bp\s*$", 1))
    factor = F.when(unit == "k", 1e3).when(unit == "m", 1e6).when(unit == "g", 1e9).otherwise(1.0)
    return F.nullif(F.regexp_extract(text, r"^\s*([0-9.]+)\s*[kKmMgG]?bp\s*$", 1), F.lit("")).try_cast("double") * factor

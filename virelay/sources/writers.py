"""Writers of tab-separated tables, FASTQ, FASTA and JSON; null is written NA."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from virelay.operators.relops import TableError, assert_unique


def write_tsv(df: DataFrame, path: str, by: list[str] | None = None, compression: str = "gzip") -> None:
    """A folder of compressed parts with a header; ``by`` makes a folder for each value instead of a file for each key."""
    w = df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").option("emptyValue", "").option("quote", "").option("compression", compression)
    (w.partitionBy(*by) if by else w).csv(path)


def fastq_text(hits: DataFrame, drop_unpaired: bool = False) -> DataFrame:
    """(value): FASTQ records of hits, ``id 1`` and ``id 2`` for pairs, ``id`` alone without query_seq_rev.

    A missing mate is one N of quality ``!``, or with ``drop_unpaired`` its read is left out.
    """
    paired = "query_seq_rev" in hits.columns

    def record(name, seq, qual):
        return F.concat(F.lit("@"), name, F.lit("\n"), F.coalesce(seq, F.lit("N")), F.lit("\n+\n"), F.when(seq.isNull(), F.lit("!")).otherwise(qual))

    if not paired:
        return hits.select(record(F.col("seq_id"), F.col("query_seq"), F.col("query_qual")).alias("value"))
    rows = hits.where(F.col("query_seq").isNotNull() & F.col("query_seq_rev").isNotNull()) if drop_unpaired else hits
    both = F.concat(record(F.concat("seq_id", F.lit(" 1")), F.col("query_seq"), F.col("query_qual")), F.lit("\n"), record(F.concat("seq_id", F.lit(" 2")), F.col("query_seq_rev"), F.col("query_qual_rev")))
    return rows.select(both.alias("value"))


def fasta_text(df: DataFrame, name: str, seq: str) -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq)).alias("value"))


def write_text(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.mode("overwrite").option("compression", compression).text(path)


def group_json(df: DataFrame, group: str, sample: str, payload: str) -> DataFrame:
    """(group, json): for each group a JSON object from sample to its payload (JSON text), with sample and group put in.

    A sample that occurs twice in a group is an error. For per-sample reports: a group holds as many entries as it has samples.
    """
    assert_unique(df, [group, sample])
    fields = F.from_json(payload, "map<string,string>")
    own = F.create_map(F.lit("sample"), F.col(sample), F.lit("group"), F.col(group))
    entry = F.struct(F.col(sample).alias("key"), F.map_concat(F.map_filter(F.coalesce(fields, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("sample", "group")), own).alias("value"))
    return df.select(F.col(group), entry.alias("e")).groupBy(group).agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("json"))


def empty_outputs(groups: DataFrame, outputs: DataFrame, group: str = "group") -> DataFrame:
    """(group) of groups without any output, for which tables with a header alone are wanted; names with ``..`` or ``/`` are errors."""
    bad = groups.where(F.col(group).contains("..") | F.col(group).contains("/")).limit(1).collect()
    if bad:
        raise TableError(f"a group's name can't be part of a path: {bad[0][group]}")
    return groups.select(group).distinct().join(outputs.select(group).distinct(), group, "left_anti")

"""Readers of tab-separated tables, FASTQ, FASTA, SAM, taxonomy dumps and tool reports.

Text files compressed by gzip can't be split, so a file is one task; rows are spread afterwards by whatever comes next. Null is written NA.
"""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from virelay.operators.relops import TableError, assert_unique

#: Columns of tabular search reports and cluster records (fixed values).
BLAST_COLUMNS = "qseqid string, sseqid string, sgi string, staxid bigint, qlen int, evalue double, bitscore double, qcovs double, length int, pident double, mismatch int, gapopen int, sstrand string, qstart int, qend int, sstart int, send int"
CLUSTER_COLUMNS = "type string, cluster bigint, length int, identity string, orientation string, u1 string, u2 string, cigar string, query string, target string"
REPORT_COLUMNS = "pc_reads_total double, n_reads_clade bigint, n_reads_direct bigint, n_minimizers_total bigint, n_minimizers_distinct bigint, rank string, taxid bigint, name string"


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """A table as typed columns, or as text without a schema. Quotes and backslashes are ordinary characters."""
    r = spark.read.option("sep", "\t").option("header", header).option("quote", "").option("escape", "").option("nullValue", "NA").option("emptyValue", "")
    return (r.schema(schema).option("enforceSchema", False) if schema is not None and header else r.schema(schema) if schema is not None else r).csv(path)


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, BLAST_COLUMNS, header=False)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Records of a cluster file; a type other than S, H, C or N is an error when rows are read."""
    df = read_tsv(spark, path, CLUSTER_COLUMNS, header=False)
    bad = F.raise_error(F.concat(F.lit("unknown record type: "), F.coalesce("type", F.lit("null"))))
    return df.withColumn("type", F.when(F.col("type").isin("S", "H", "C", "N"), F.col("type")).otherwise(bad))


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, REPORT_COLUMNS, header=False).withColumn("name", F.trim("name"))


def _numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no from 0, line) of text files, which many tasks may read in blocks.

    The lines of a block have consecutive ids in the task that reads it; how many lines lie in the blocks before is summed from one row for each block.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"),
        F.rtrim(F.col("value"), F.lit("\r")).alias("line"),
    )
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("first"))
    before = F.sum("size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    begin = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(begin, ["file", "block"]).select("file", (F.col("n") + F.col("shift")).alias("line_no"), "line")


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record, seq_id, description, seq, qual): records are four lines, numbered from 1 in the order of the file.

    Lines are numbered over the blocks of a file, so a large plain file is read by many tasks; the four lines of a record are combined
    in the task that has them, and meet by record where a block ends between. A record that doesn't look like one, or whose sequence and qualities differ in
    length, or a file that ends within one, is an error when rows are read; an empty line at the end is none.
    """
    part = F.col("line_no") % 4
    of = {c: F.max(F.when(part == i, F.col("line"))).alias(c) for i, c in enumerate(("head", "seq", "plus", "qual"))}
    four = _numbered_lines(spark, path).groupBy("file", (F.floor(F.col("line_no") / 4) + 1).alias("record")).agg(*of.values()).where("head <> '' OR seq IS NOT NULL")
    ok = F.col("head").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual"))
    bad = F.raise_error(F.concat("file", F.lit(": record "), F.col("record").cast("string"), F.lit(" isn't FASTQ: "), F.coalesce(F.substring("head", 1, 60), F.lit(""))))
    name = F.when(F.coalesce(ok, F.lit(False)), F.regexp_extract("head", r"^@(\S*)", 1)).otherwise(bad)
    rest = F.nullif(F.regexp_extract("head", r"^@\S*\s+(.*)$", 1), F.lit(""))
    return four.select("file", "record", name.alias("seq_id"), rest.alias("description"), "seq", "qual")


def pair_mates(fwd: DataFrame, rev: DataFrame) -> DataFrame:
    """One row for each read of two FASTQ tables, the mate's columns with the suffix _rev; names may end in /1 and /2."""
    def name(c: str):
        return F.regexp_replace(c, "/[12]$", "")

    a = fwd.select(name("seq_id").alias("seq_id"), "seq", "qual")
    b = rev.select(name("seq_id").alias("seq_id"), F.col("seq").alias("seq_rev"), F.col("qual").alias("qual_rev"))
    return a.join(b, "seq_id")


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, seq_id, description, seq) of each sequence; lines of a sequence are joined.

    A sequence begins at a ``>`` at the start of a line; others belong to headers. A sequence is one row, however long: a row must hold a chromosome.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"^\s*>", "").alias("value")).where(F.trim("value") != "")
    head = F.rtrim(F.regexp_extract("value", r"^([^\n]*)", 1), F.lit(" \t\r"))
    return raw.select(
        "file", F.regexp_extract(head, r"^(\S*)", 1).alias("seq_id"), F.nullif(F.regexp_extract(head, r"^\S*\s+(.*)$", 1), F.lit("")).alias("description"),
        F.regexp_replace(F.regexp_extract("value", r"(?s)^[^\n]*\n?(.*)$", 1), r"\s", "").alias("seq"),
    )


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The eleven fields, typed, then tags as a map, the tags AS, XS, YS, NM, YT, and ``ordinal``: the order within the file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ordinal"), "value").where(~F.col("value").startswith("@") & (F.col("value") != ""))
    f = F.split("value", "\t")
    tags = F.transform(F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))), lambda t: F.split(t, ":", 3))
    typed = lines.select(
        "file", "ordinal", f[0].alias("seq_id"), f[1].cast("int").alias("flag"), f[2].alias("rname"), f[3].cast("int").alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"),
        f[6].alias("rnext"), f[7].cast("int").alias("pnext"), f[8].cast("int").alias("tlen"), f[9].alias("seq"), f[10].alias("qual"),
        F.map_from_entries(F.transform(tags, lambda t: F.struct(t[0], t[2]))).alias("tags"),
    )
    return typed.select(
        "*", F.col("tags")["AS"].cast("int").alias("as_score"), F.col("tags")["XS"].cast("int").alias("xs_score"), F.col("tags")["YS"].cast("int").alias("ys_score"), F.col("tags")["NM"].cast("int").alias("nm"), F.col("tags")["YT"].alias("pair_status")
    )


def check_pair_status(sam: DataFrame, paired: bool) -> DataFrame:
    """The rows; a pair status that can't be in paired (UU) or unpaired data (UP, CP, DP) is an error when rows are read."""
    good = ["UP", "CP", "DP"] if paired else ["UU"]
    bad = F.raise_error(F.concat(F.lit("pair status can't be: "), F.coalesce("pair_status", F.lit("null"))))
    return sam.withColumn("pair_status", F.when(F.col("pair_status").isin(good), F.col("pair_status")).otherwise(bad))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(node, parent, rank) of a nodes dump, whose fields are parted by tab, bar, tab."""
    f = F.split("value", r"\t\|\t?")
    return spark.read.text(path).where("value <> ''").select(f[0].try_cast("bigint").alias("node"), f[1].try_cast("bigint").alias("parent"), F.get(f, F.lit(2)).alias("rank"))


def check_nodes(nodes: DataFrame, root: int = 1, artificial: int | None = None) -> DataFrame:
    """The nodes; an error at once if the root isn't its own parent, or the artificial taxon isn't both a node and a parent."""
    ids = [root] if artificial is None else [root, artificial]
    seen = nodes.where(F.col("node").isin(ids) | F.col("parent").isin(ids)).agg(
        F.count_if((F.col("node") == root) & (F.col("parent") == root)).alias("root"), *[F.count_if(F.col(c) == ids[-1]).alias(c) for c in ("node", "parent")]
    ).first()
    if not seen.root:
        raise TableError(f"root {root} must be its own parent")
    if not (seen["node"] and seen["parent"]):
        raise TableError(f"taxon {ids[-1]} must be a node and a parent")
    return nodes


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """(node, name, name_class) of a names dump."""
    f = F.split("value", r"\t\|\t?")
    return spark.read.text(path).where("value <> ''").select(f[0].try_cast("bigint").alias("node"), f[1].alias("name"), F.get(f, F.lit(3)).alias("name_class"))


def preferred_names(names: DataFrame) -> DataFrame:
    """(node, name): the scientific name, else the first by name; a null name is ``unknown virus``."""
    pick = F.min(F.struct((F.coalesce("name_class", F.lit("")) != "scientific name").alias("p"), "name")).alias("m")
    return names.groupBy("node").agg(pick).select("node", F.coalesce("m.name", F.lit("unknown virus")).alias("name"))


#: Platforms that sample sheets may name, those whose reads are single, and those that are worked on (fixed values).
PLATFORMS, SINGLE_END, IMPLEMENTED = ("illumina", "aviti", "ont", "pacbio"), ("ont", "pacbio"), ("illumina", "aviti", "ont")


def read_sample_sheet(spark: SparkSession, path: str, platform: str, single_end_platforms: tuple[str, ...] = SINGLE_END) -> DataFrame:
    """(sample, fastq_1[, fastq_2]) or (sample, fastq); the header tells single from paired, and has to suit the platform. Sheets are small; errors come at once.

    Errors: an unknown platform or one that isn't worked on, a header that suits neither, an empty or repeated sample, an empty file.
    """
    for names, what in ((PLATFORMS, "unknown"), (IMPLEMENTED, "not worked on")):
        if platform not in names:
            raise TableError(f"platform is {what}: {platform}")
    df = spark.read.option("header", True).csv(path)
    names = df.columns
    if names[:3] == ["sample", "fastq_1", "fastq_2"]:
        paired = True
    elif names[:2] == ["sample", "fastq"]:
        paired = False
    else:
        raise TableError(f"unknown header of a sample sheet: {names}")
    if paired == (platform in single_end_platforms):
        raise TableError(f"platform {platform} doesn't go with {'paired' if paired else 'single'} reads")
    empty = F.greatest(*[(F.coalesce(F.trim(c), F.lit("")) == "").cast("int") for c in names[: 3 if paired else 2]])
    bad = df.groupBy("sample").agg(F.max(empty).alias("empty"), F.count(F.lit(1)).alias("n")).where("empty > 0 OR n > 1").limit(1).collect()
    if bad:
        raise TableError(f"sample is empty, repeated or without a file: {bad[0]['sample']}")
    return df


def expected_suffixes(path: str, platform: str, table: tuple[str, ...], base: str = "expected-outputs-run", extra: str = "expected-outputs-run-shortread-extra") -> list[str]:
    """What follows ``{SAMPLE}_`` in the outputs that a table of a TOML file lists, ``.gz`` left out, sorted, each once; those of ``extra`` only for illumina. Other entries are left out."""
    with open(path, "rb") as f:
        lists = tomllib.load(f)
    for k in table:
        lists = lists.get(k, {})
    wanted = [*lists.get(base, []), *(lists.get(extra, []) if platform == "illumina" else [])]
    return sorted({s.split("{SAMPLE}_", 1)[1].removesuffix(".gz") for s in wanted if "{SAMPLE}_" in s})


def read_run_inputs(spark: SparkSession, path: str, base: str) -> DataFrame:
    """(label, results_dir, groups_path) of a list of runs; relative paths are taken from ``base``; empty ones are errors when read."""
    df = spark.read.option("header", True).csv(path)
    if df.columns != ["label", "run_results_dir", "groups_tsv"]:
        raise TableError(f"header must be label,run_results_dir,groups_tsv, not {df.columns}")

    def placed(c: str):
        absolute = F.col(c).rlike(r"^(/|[a-z0-9]+://)")
        return F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.raise_error(F.lit(f"{c} is empty"))).when(absolute, F.col(c)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.col(c)))

    return df.select("label", placed("run_results_dir").alias("results_dir"), placed("groups_tsv").alias("groups_path"))


def run_groups(spark: SparkSession, inputs: DataFrame) -> DataFrame:
    """(label, results_dir, sample, group): the rows of the tables of groups that read_run_inputs names; a sample twice in a run is an error at once."""
    tables = inputs.select("label", "results_dir", "groups_path")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"^(?:file:)?/*(.*)$", 1)
    paths = [x.groups_path for x in tables.select("groups_path").distinct().collect()]  # one for each run
    if not paths:
        return tables.select("label", "results_dir").limit(0).withColumns({"sample": F.lit("x"), "group": F.lit("x")})
    groups = read_tsv(spark, paths, "sample string, `group` string").select(name.alias("__file"), "sample", "group")
    out = tables.join(groups, F.regexp_extract("groups_path", r"^(?:file:)?/*(.*)$", 1) == F.col("__file")).select("label", "results_dir", "sample", "group")
    return assert_unique(out, ["label", "sample"])


def discover_outputs(samples: DataFrame, suffixes: list[str], files: DataFrame) -> DataFrame:
    """(sample, suffix, file) of each sample and suffix, the compressed file before the plain one; an error lists what is missing.

    ``files`` has (file). The list of missing files is at most a hundred long in the message.
    """
    base = F.regexp_extract("file", r"([^/]+)$", 1)
    wanted = samples.select("sample", F.explode(F.array(*[F.lit(s) for s in suffixes])).alias("suffix")).withColumn("name", F.concat_ws("_", "sample", "suffix"))
    have = files.select("file", F.regexp_replace(base, r"\.gz$", "").alias("name"), base.endswith(".gz").alias("gz"))
    best = have.groupBy("name").agg(F.max_by("file", "gz").alias("file"))
    out = wanted.join(best, "name", "left")
    missing = [r.name for r in out.where("file IS NULL").select("name").limit(100).collect()]
    if missing:
        raise TableError(f"outputs are missing: {', '.join(sorted(missing))}")
    return out.select("sample", "suffix", "file")

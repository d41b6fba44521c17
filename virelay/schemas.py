"""Published tables: types, what is required, keys; and the rows that break them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A column's type and constraints."""

    kind: str
    required: bool = True
    minimum: float | None = None
    maximum: float | None = None
    pattern: str | None = None
    values: tuple[str, ...] | None = None


@dataclass(frozen=True)
class TableRules:
    columns: dict[str, Rule]
    key: tuple[str, ...] = ()
    name: str = field(default="")


_N, _P = Rule("bigint", minimum=0), Rule("double", minimum=0)
_S = Rule("string")
#: Published tables (names and types are fixed values).
TABLES = {
    "clade_counts": TableRules({"group": _S, "taxid": _N, "parent_taxid": _N, "reads_direct_total": _N, "reads_direct_dedup": _N, "reads_clade_total": _N, "reads_clade_dedup": _N}, ("group", "taxid")),
    "duplicate_stats": TableRules({"prim_align_genome_id_all": Rule("string", pattern=r"^[^/]+(/[^/]+)?$"), "prim_align_dup_exemplar": Rule("string", required=False), "prim_align_dup_count": Rule("bigint", minimum=1), "prim_align_dup_pairwise_match_frac": Rule("double", minimum=0, maximum=1)}, ("prim_align_dup_exemplar",)),
    "kraken": TableRules({"pc_reads_total": Rule("double", minimum=0, maximum=100), "n_reads_clade": _N, "n_reads_direct": _N, "n_minimizers_total": _N, "n_minimizers_distinct": _N, "rank": _S, "taxid": _N, "name": _S, "sample": _S, "ribosomal": Rule("string", values=("TRUE", "FALSE")), "group": _S}, ("group", "sample", "taxid", "ribosomal")),
    "bracken": TableRules({"name": _S, "taxid": _N, "rank": _S, "kraken2_assigned_reads": _N, "added_reads": _N, "new_est_reads": _N, "fraction_total_reads": Rule("double", minimum=0, maximum=1), "sample": _S, "ribosomal": Rule("string", values=("TRUE", "FALSE")), "group": _S}, ("group", "sample", "taxid", "ribosomal")),
    "read_counts": TableRules({"sample": _S, "n_reads_single": _N, "n_read_pairs": Rule("bigint", required=False, minimum=0), "group": _S}, ("group", "sample")),
    "qc_length_stats": TableRules({"length": _N, "n_sequences": _N, "file": _S, "stage": _S, "sample": _S, "group": _S}, ("group", "sample", "stage", "file", "length")),
    "qc_quality_base_stats": TableRules({"position": _N, "mean_phred_score": _P, "file": _S, "stage": _S, "sample": _S, "group": _S}, ("group", "sample", "stage", "file", "position")),
}


def violations(df: DataFrame, rules: TableRules) -> DataFrame:
    """(column, problem, n_rows): broken constraints; an empty result means that the table is good.

    Cells are compared as text, so a table read as text can be checked. Columns are looked at in one pass; the key in one aggregate of its own.
    """
    checks = []
    for c, r in rules.columns.items():
        if c not in df.columns:
            checks.append((c, "missing column", F.lit(True)))
            continue
        x = F.col(f"`{c}`")
        typed = x.try_cast(r.kind)
        if r.required:
            checks.append((c, "null", x.isNull()))
        checks.append((c, f"not {r.kind}", x.isNotNull() & typed.isNull()))
        if r.minimum is not None:
            checks.append((c, f"below {r.minimum}", typed < r.minimum))
        if r.maximum is not None:
            checks.append((c, f"above {r.maximum}", typed > r.maximum))
        if r.pattern:
            checks.append((c, "pattern", ~x.cast("string").rlike(r.pattern)))
        if r.values:
            checks.append((c, "value", ~x.cast("string").isin(*r.values)))
    checks += [(c, "unknown column", F.lit(True)) for c in df.columns if c not in rules.columns]
    sums = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.coalesce(k, F.lit(False))).alias(f"c{i}") for i, (_, _, k) in enumerate(checks)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("problem"), F.col(f"c{i}").alias("n_rows")) for i, (c, p, _) in enumerate(checks)]
    out = sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("n_rows > 0")
    if rules.key and set(rules.key) <= set(df.columns):
        twice = df.groupBy(*rules.key).count().where("count > 1").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 0")
        out = out.unionByName(twice.select(F.lit(",".join(rules.key)).alias("column"), F.lit("repeated key").alias("problem"), "n_rows"))
    return out

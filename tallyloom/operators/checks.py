"""Data checks. Each returns the rows that violate it; an empty result means the check passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import demux, joins
from tallyloom.operators.ordered import as_list

# Parts of a sample name that would be taken for read-file names.
FORBIDDEN_PARTS = ("_R1", ".R1", "_R2", ".R2")


class CheckFailed(ValueError):
    """A gate found violating rows."""


def gate(violations: DataFrame, message: str, show: int = 5) -> None:
    """Raise with a few examples when there is any violating row."""
    rows = violations.limit(show).collect()
    if rows:
        raise CheckFailed(f"{message}: {[r.asDict() for r in rows]}")


def missing_columns(df: DataFrame, needed: Sequence[str]) -> list[str]:
    return [c for c in needed if c not in df.columns]


def duplicated(df: DataFrame, keys) -> DataFrame:
    k = as_list(keys)
    return df.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def sample_names(meta: DataFrame, col: str = "sample_id") -> DataFrame:
    """Duplicated names, names with blanks or forbidden parts, and names contained in other names."""
    x = meta.groupBy(F.col(col).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    bad = F.lit(False)
    for part in FORBIDDEN_PARTS:
        bad = bad | F.contains(F.col("name"), F.lit(part))
    rows = F.array_compact(F.array(
        F.when(F.col("n") > 1, F.lit("duplicated")), F.when(F.contains(F.col("name"), F.lit(" ")), F.lit("has a blank")), F.when(bad, F.lit("forbidden part"))))
    inner = joins.contained_ids(meta, col).select(F.col("inner_id").alias("name"), F.lit("contained in another").alias("problem")).distinct()
    return x.select("name", F.explode(rows).alias("problem")).unionByName(inner)


def metadata_levels(meta: DataFrame, vars_: Sequence[str], limit: int = 10) -> DataFrame:
    """Non-text variables with too many values, and variables without any value."""
    kinds = dict(meta.dtypes)
    n = meta.agg(*[F.countDistinct(v).alias(v) for v in vars_]).unpivot([], list(vars_), "variable", "n_values")
    text = [v for v in vars_ if kinds[v] == "string"]
    many = (F.col("n_values") > limit) & ~F.col("variable").isin(*text) if text else F.col("n_values") > limit
    return n.where(many | (F.col("n_values") == 0)).withColumn("problem", F.when(F.col("n_values") == 0, "all missing").otherwise("too many values"))


def not_in_reference(df: DataFrame, ref: DataFrame, keys) -> DataFrame:
    k = as_list(keys)
    return df.select(*k).distinct().join(ref.select(*k).distinct(), k, "left_anti")


def set_differences(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Keys found on one side only."""
    k = as_list(keys)
    left = not_in_reference(a, b, k).withColumn("only_in", F.lit("first"))
    return left.unionByName(not_in_reference(b, a, k).withColumn("only_in", F.lit("second")))


def exclusion_list(listed: DataFrame, genes: DataFrame) -> DataFrame:
    """Problems of a gene list with one column gene_id or symbol: doubles and unknown genes."""
    cols = [c for c in ("gene_id", "symbol") if c in listed.columns]
    if len(cols) != 1:
        raise CheckFailed("an exclusion list needs exactly one of gene_id and symbol")
    c = cols[0]
    dup = duplicated(listed, c).select(F.col(c).cast("string").alias("value"), F.lit("duplicated").alias("problem"))
    miss = not_in_reference(listed, genes, c).select(F.col(c).cast("string").alias("value"), F.lit("unknown").alias("problem"))
    return dup.unionByName(miss)


def marker_set(custom: DataFrame) -> DataFrame:
    """Doubled symbols of a custom marker table; missing columns raise."""
    if "label" not in custom.columns or not {"symbol", "ensembl_id"} & set(custom.columns):
        raise CheckFailed("custom markers need label and symbol or ensembl_id")
    return duplicated(custom, "symbol" if "symbol" in custom.columns else "ensembl_id")


def splice_features(features: DataFrame, genes: DataFrame) -> DataFrame:
    """Genes that lack one of the three splice rows, or are not annotated."""
    have = features.groupBy("gene_id").agg(F.countDistinct("splice").alias("n"))
    known = genes.select("gene_id").distinct().withColumn("_k", F.lit(True))
    x = have.join(known, "gene_id", "left")
    return x.where((F.col("n") != 3) | F.col("_k").isNull()).select(
        "gene_id", F.when(F.col("_k").isNull(), "unknown gene").otherwise("incomplete").alias("problem"))


def qc_values(cells: DataFrame, names: Sequence[str], signed: Sequence[str] = ("logit_mito", "logit_spliced", "splice_ratio")) -> DataFrame:
    """Cells with missing, infinite or negative metrics, and repeated or missing ids."""
    bad = F.lit(False)
    for c in names:
        v = F.col(c).cast("double")
        wrong = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
        bad = bad | (wrong if c in signed else wrong | (v < 0))
    values = cells.where(bad | F.col("cell_id").isNull()).select("cell_id", F.lit("bad value").alias("problem"))
    return values.unionByName(duplicated(cells, "cell_id").select("cell_id", F.lit("duplicated").alias("problem")))


def hvg_selection(hvgs: DataFrame, excluded: DataFrame, n: int) -> DataFrame:
    """Selected genes that are excluded, and a wrong number of selected genes."""
    sel = hvgs.where("highly_variable")
    bad = sel.join(excluded.select("gene_id"), "gene_id", "left_semi").select(
        F.col("gene_id").cast("string").alias("value"), F.lit("excluded gene selected").alias("problem"))
    count = sel.agg(F.count(F.lit(1)).alias("k")).where(F.col("k") != n).select(
        F.col("k").cast("string").alias("value"), F.lit("wrong number selected").alias("problem"))
    return bad.unionByName(count)


def nan_embeddings(emb: DataFrame) -> DataFrame:
    return emb.where(F.exists("embedding", lambda x: F.isnan(x) | x.isNull())).select("cell_id")


def proportions(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull() | (F.col(col) < 0) | (F.col(col) > 1))


def enough_good_batches(status: DataFrame, batch: str = "batch", least: int = 2) -> DataFrame:
    """One row when fewer than ``least`` batches passed."""
    return status.agg(F.count_if(~F.col(f"bad_{batch}")).alias("n_good")).where(F.col("n_good") < least)


def constant_within(df: DataFrame, by, cols: Sequence[str]) -> DataFrame:
    """Groups in which an annotation takes more than one value."""
    k = as_list(by)
    n = df.groupBy(*k).agg(*[F.countDistinct(c).alias(c) for c in cols]).unpivot(k, list(cols), "variable", "n_values")
    return n.where("n_values > 1")


def unknown_labels(labels: DataFrame, col: str, wanted: Sequence[str]) -> DataFrame:
    have = labels.select(F.col(col).cast("string").alias("label")).distinct()
    want = labels.sparkSession.createDataFrame([(w,) for w in wanted], "label string")
    return want.join(have, "label", "left_anti")


def tag_signal(tags: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tags with a median count below one."""
    return demux.check_tags(tags, expected).where("status = 'error'")


def identical_tables(tables: DataFrame, run: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Runs whose table differs from the most common one, by an order-free hash of the rows."""
    cols = [c for c in tables.columns if c != run and c not in ignore]
    h = F.xxhash64(*cols)
    sig = tables.groupBy(run).agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x"))
    common = sig.groupBy("n", "s", "x").agg(F.count(F.lit(1)).alias("k")).agg(F.max_by(F.struct("n", "s", "x"), F.struct("k", "n", "x")).alias("c")).scalar()
    return sig.withColumn("_c", common).where(~((F.col("n") == F.col("_c.n")) & (F.col("s") == F.col("_c.s")) & (F.col("x") == F.col("_c.x")))).select(run)

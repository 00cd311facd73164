"""Count-matrix operators on long tables: one row per non-zero (cell, gene, splice) count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import feature_gene, feature_splice, safe_ratio
from tallyloom.operators import ordered
from tallyloom.operators.ordered import as_list


def split_features(counts: DataFrame) -> DataFrame:
    """``feature`` (``<gene>_S/_U/_A``) to ``gene_id`` and ``splice``."""
    return counts.withColumns({"gene_id": feature_gene("feature"), "splice": feature_splice("feature")}).drop("feature")


def bind_splice_assays(spliced: DataFrame, unspliced: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """Three tables of (run_id, barcode, gene_id, count) on one feature axis."""
    parts = [
        df.select("run_id", "barcode", F.concat_ws("_", "gene_id", F.lit(tag)).alias("feature"), "count")
        for tag, df in (("S", spliced), ("U", unspliced), ("A", ambiguous))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sum_splice(counts: DataFrame, keys: Sequence[str] = ("cell_id", "gene_id")) -> DataFrame:
    """Spliced + unspliced + ambiguous per cell and gene."""
    return counts.groupBy(*keys).agg(F.sum("count").alias("count"))


def usa_totals(counts: DataFrame, by="barcode", prefix: str = "pre") -> DataFrame:
    """Per barcode the sums of spliced, unspliced and ambiguous counts."""
    tag = F.col("splice")
    return counts.groupBy(*as_list(by)).agg(*[
        F.sum(F.when(tag == t, F.col("count")).otherwise(0.0)).alias(f"{prefix}_{t}") for t in ("S", "U", "A")])


def barcode_qc_metrics(pre: DataFrame, post: DataFrame | None, by="barcode", keep_uncorrected: bool = True) -> DataFrame:
    """Totals before and after ambient removal; ``keep_uncorrected`` keeps barcodes without a corrected total."""
    before = usa_totals(pre, by, "pre")
    if post is None:
        return before
    return before.join(usa_totals(post, by, "post"), as_list(by), "left" if keep_uncorrected else "inner")


def drop_empty_barcodes(counts: DataFrame, by="barcode") -> DataFrame:
    """Remove barcodes whose total is zero, explicit zero rows included."""
    keys = as_list(by)
    alive = counts.groupBy(*keys).agg(F.sum("count").alias("_t")).where("_t > 0").drop("_t")
    return counts.join(alive, keys, "left_semi")


def min_umi_barcodes(totals: DataFrame, minimum: float = 10, prefix: str = "pre") -> DataFrame:
    return totals.where(F.col(f"{prefix}_S") + F.col(f"{prefix}_U") + F.col(f"{prefix}_A") >= minimum)


def keep_genes(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """Counts of the listed genes; an error when none of the genes has a count."""
    kept = counts.join(genes.select("gene_id").distinct(), "gene_id", "left_semi")
    if kept.isEmpty():
        raise ValueError("no gene is left: none of the listed genes has a count")
    return kept


# Gene types that are recorded per cell and then left out.
RRNA_TYPE = "rRNA"
MT_RRNA_TYPE = "Mt_rRNA"


def drop_rrna_genes(counts: DataFrame, genes: DataFrame, types: Sequence[str] = (RRNA_TYPE, MT_RRNA_TYPE)) -> DataFrame:
    return counts.join(genes.where(F.col("gene_type").isin(*types)).select("gene_id"), "gene_id", "left_anti")


def flag_mito_genes(genes: DataFrame, pattern: str = "^(MT|mt)-") -> DataFrame:
    return genes.withColumn("is_mito", F.col("symbol").rlike(pattern))


def exclude_mito(counts: DataFrame, genes: DataFrame, exclude: bool = True) -> DataFrame:
    """Drop mitochondrial genes; cells without other counts leave the long table by themselves."""
    if not exclude:
        return counts
    return counts.join(genes.where("is_mito").select("gene_id"), "gene_id", "left_anti").where(F.col("count") > 0)


def gene_totals(gene_sums: DataFrame, n_cells: Column | float) -> DataFrame:
    """Total, cells expressing, share expressing and CPM per gene over all cells."""
    n = n_cells if isinstance(n_cells, Column) else F.lit(float(n_cells))
    per_gene = gene_sums.groupBy("gene_id").agg(
        F.sum("count").alias("total"), F.count_if(F.col("count") > 0).alias("n_expressed"))
    grand = per_gene.agg(F.sum("total").alias("t")).scalar()
    return per_gene.withColumns({
        "prop_expressed": F.col("n_expressed") / n,
        "cpm": F.col("total") / grand * F.lit(1e6),
    })


def gene_mean_var(gene_sums: DataFrame, n_cells: DataFrame, by="batch") -> DataFrame:
    """Mean and unbiased variance per gene over all cells of the group, absent counts being zeros.

    One pass: only sums and sums of squares are shuffled; ``n_cells`` gives the denominator.
    """
    keys = as_list(by)
    sums = gene_sums.groupBy(*keys, "gene_id").agg(
        F.sum("count").alias("_s"), F.sum(F.col("count") * F.col("count")).alias("_q"))
    n = F.col("n_cells")
    mean = F.col("_s") / n
    joined = sums.join(n_cells, keys)
    return joined.select(
        *keys, "gene_id", "n_cells", mean.alias("mean"),
        F.when(n > 1, (F.col("_q") - n * mean * mean) / F.when(n > 1, n - 1)).alias("variance"))


def clipped_sums(gene_sums: DataFrame, clips: DataFrame, by="batch") -> DataFrame:
    """Sum and sum of squares per gene after counts are cut at ``clip_val``."""
    keys = [*as_list(by), "gene_id"]
    x = F.least(F.col("count"), F.col("clip_val"))
    return (
        gene_sums.join(clips.select(*keys, "clip_val"), keys).groupBy(*keys)
        .agg(F.sum(x).alias("counts_sum"), F.sum(x * x).alias("squared_counts_sum"))
    )


def library_sizes(counts: DataFrame, by="cell_id", out: str = "lib_size") -> DataFrame:
    return counts.groupBy(*as_list(by)).agg(F.sum("count").alias(out))


def log_normalise(gene_sums: DataFrame, libs: DataFrame, scale: float = 1e4, cell: str = "cell_id") -> DataFrame:
    """ln(1 + count / library * scale); absent counts stay zero and need no row."""
    return (
        gene_sums.join(libs, cell)
        .withColumn("logcount", F.log1p(safe_ratio(F.col("count"), F.col("lib_size")) * F.lit(float(scale))))
        .drop("lib_size")
    )


def normalise_total(gene_sums: DataFrame, cell: str = "cell_id", by=None) -> DataFrame:
    """Scale every cell to the median library (over all, or per group), then log1p."""
    keys = as_list(by)
    libs = library_sizes(gene_sums, [*keys, cell])
    if keys:
        libs = libs.join(ordered.median_by(libs, keys, "lib_size", "target"), keys)
    else:
        target = ordered.median_by(libs, None, "lib_size", "target")
        libs = libs.withColumn("target", target.scalar())
    return (
        gene_sums.join(libs, [*keys, cell])
        .withColumn("normcount", F.log1p(F.col("count") / F.col("lib_size") * F.col("target")))
        .drop("lib_size", "target")
    )

"""Tables behind reports that combine several steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import labels, ordered, qc
from tallyloom.operators.ordered import as_list


def rescale(df: DataFrame, cols: Sequence[str], lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Columns stretched to [lo, hi] by their range (one aggregate row for all columns)."""
    ends = df.agg(F.struct(*[F.min(c).alias(f"min_{c}") for c in cols], *[F.max(c).alias(f"max_{c}") for c in cols]).alias("e")).scalar()
    x = df.withColumn("_e", ends)
    for c in cols:
        span = F.col(f"_e.max_{c}") - F.col(f"_e.min_{c}")
        x = x.withColumn(c, lo + (hi - lo) * F.when(span > 0, (F.col(c) - F.col(f"_e.min_{c}")) / F.when(span > 0, span)).otherwise(0.5))
    return x.drop("_e")


def bin2d(df: DataFrame, x: str, y: str, bins: int = 50, value: str | None = None, by=None) -> DataFrame:
    """Counts (or the mean of a value) in square bins over two coordinates."""
    ends = df.agg(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).alias("e")).scalar()
    d = df.withColumn("_e", ends)

    def place(c: str, lo: str, hi: str):
        span = F.col(f"_e.{hi}") - F.col(f"_e.{lo}")
        return F.when(span > 0, F.least(F.floor((F.col(c) - F.col(f"_e.{lo}")) / F.when(span > 0, span) * bins), F.lit(bins - 1))).otherwise(0).cast("int")

    keys = as_list(by)
    aggs = [F.count(F.lit(1)).alias("n")] + ([F.avg(value).alias(f"mean_{value}")] if value else [])
    return d.groupBy(*keys, place(x, "x0", "x1").alias("x_bin"), place(y, "y0", "y1").alias("y_bin")).agg(*aggs)


def cluster_qc_long(cells: DataFrame, clusters: DataFrame, res_cols: Sequence[str], metrics: Sequence[str], min_size: int = 10) -> DataFrame:
    """Quality metrics in long form by cluster and resolution, small clusters dropped."""
    cl = clusters.select("cell_id", *[F.col(c).cast("string") for c in res_cols]).unpivot(["cell_id"], list(res_cols), "res", "cluster")
    cl = labels.drop_small_groups(cl.where(F.col("cluster").isNotNull()), ["res", "cluster"], min_size)
    return cl.join(qc.metrics_long(cells, ["cell_id"], metrics), "cell_id")


def expression_on_embedding(gene_sums: DataFrame, libs: DataFrame, genes: DataFrame, n_cells: DataFrame, scale: float = 1e4) -> DataFrame:
    """Log expression of chosen genes, capped at each gene's 99th percentile over all cells and scaled to 1.

    Cells without a count have value 0 and no row; they enter the percentile through ``n_cells``
    (a one-row table). A percentile of 0 counts as 1.
    """
    x = gene_sums.join(genes.select("gene_id", "symbol"), "gene_id").join(libs, "cell_id").withColumn(
        "logcount", F.log1p(F.col("count") / F.col("lib_size") * scale))
    # order statistics of the non-zero part, shifted by the zeros
    runs = ordered.running_counts(x, ["gene_id"], "logcount")
    n = n_cells.agg(F.sum("n_cells").alias("n")).scalar()
    z = runs.withColumn("_N", n).withColumn("_z", F.col("_N") - F.col("group_n"))
    at = (F.col("_N") - 1) * 0.99
    lo, hi = F.floor(at), F.least(F.floor(at) + 1, F.col("_N") - 1)
    q = z.groupBy("gene_id", "_N", "_z").agg(
        F.min(F.when(F.col("cum") + F.col("_z") > lo, F.col("logcount"))).alias("a"), F.min(F.when(F.col("cum") + F.col("_z") > hi, F.col("logcount"))).alias("b"))
    a, b = F.when(lo < F.col("_z"), 0.0).otherwise(F.col("a")), F.when(hi < F.col("_z"), 0.0).otherwise(F.col("b"))
    top = q.select("gene_id", (a + (b - a) * (at - lo)).alias("_q")).select("gene_id", F.when(F.col("_q") > 0, F.col("_q")).otherwise(1.0).alias("max_val"))
    return x.join(top, "gene_id").select("cell_id", "gene_id", "symbol", "logcount", "max_val", F.least(F.col("logcount") / F.col("max_val"), F.lit(1.0)).alias("norm_val"))

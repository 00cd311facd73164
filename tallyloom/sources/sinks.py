"""Writers of results and datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators import checks
from tallyloom.operators.counts import sum_splice
from tallyloom.operators.ordered import as_list


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Parquet, or gzip CSV with a header."""
    if fmt == "csv":
        df.write.mode(mode).option("header", True).option("compression", "gzip").csv(path)
    else:
        df.write.mode(mode).parquet(path)


def write_counts_by_batch(counts: DataFrame, path: str, batch: str = "batch", files_per_batch: int = 8, mode: str = "errorifexists") -> None:
    """Splice-summed counts in one folder per batch, clustered by gene.

    Rows are spread by batch and gene hash, so a large batch is written by several tasks and a
    reader of some genes skips row groups.
    """
    out = sum_splice(counts, (batch, "cell_id", "gene_id"))
    slot = F.pmod(F.xxhash64("gene_id"), F.lit(files_per_batch))
    out.repartition(F.col(batch), slot).sortWithinPartitions(batch, "gene_id").write.mode(mode).partitionBy(batch).parquet(path)


def write_bucketed_counts(counts: DataFrame, name: str, path: str | None = None, by: str | Sequence[str] = "batch", n_buckets: int | None = None) -> DataFrame:
    """Splice-summed counts as a table bucketed and sorted by group and gene, one file per bucket; returns the table.

    Moments and clipped sums per group and gene (``counts.gene_mean_var``, ``counts.clipped_sums``) then read it without an
    exchange of the counts, however often. ``n_buckets``: by default the session's shuffle partitions. ``path`` is a shared
    folder; without one the warehouse is used. The largest bucket holds at least the cells of the largest group
    that have its most frequent gene.
    """
    spark, keys = counts.sparkSession, [*as_list(by), "gene_id"]
    n = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = sum_splice(counts, (*as_list(by), "cell_id", "gene_id")).repartition(n, *keys)  # the hash of the buckets
    writer = out.write.bucketBy(n, *keys).sortBy(*keys).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def clean_batches(counts: DataFrame, cells: DataFrame, integration: DataFrame) -> DataFrame:
    """Counts of clean cells with the batch; doublets and doublet clusters are gone."""
    ok = integration.where(~F.col("is_dbl") & ~F.col("in_dbl_cl")).select("cell_id")
    return counts.join(cells.select("cell_id", "batch").join(ok, "cell_id", "left_semi"), "cell_id")


def clean_cells(cells: DataFrame, integration: DataFrame) -> DataFrame:
    """Cell table of clean cells with cluster and embedding columns; missing text becomes empty text."""
    ok = integration.where(~F.col("is_dbl") & ~F.col("in_dbl_cl"))
    x = cells.join(ok.drop(*[c for c in ok.columns if c in cells.columns and c != "cell_id"]), "cell_id")
    return x.fillna("", subset=[c for c, t in x.dtypes if t == "string"])


def export_clean_batches(counts: DataFrame, cells: DataFrame, genes: DataFrame, integration: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The clean dataset: counts and cells by batch, genes once."""
    write_counts_by_batch(clean_batches(counts.withColumn("splice", F.lit("all")) if "splice" not in counts.columns else counts, cells, integration), f"{path}/counts", mode=mode)
    clean_cells(cells, integration).write.mode(mode).partitionBy("batch").parquet(f"{path}/cells")
    genes.write.mode(mode).parquet(f"{path}/genes")


def subset_cells(cells: DataFrame, labels: DataFrame, clusters: DataFrame, label_col: str, selected: Sequence[str], drop_pattern: str = "^(RNA_snn_res|UMAP|pca_|hmny_pca_)") -> DataFrame:
    """Cells with one of the selected labels: old cluster columns out, new ones and the label in."""
    import re

    keep = [c for c in cells.columns if not re.search(drop_pattern, c)]
    lab = labels.where(F.col(label_col).cast("string").isin(*selected)).select("cell_id", F.col(label_col).alias("label"))
    return cells.select(*[f"`{c}`" for c in keep]).join(lab, "cell_id").join(clusters, "cell_id", "left")


def merge_identical(tables: DataFrame, run: str) -> DataFrame:
    """One copy of a table that must be the same for every run."""
    checks.gate(checks.identical_tables(tables, run), "tables differ between runs")
    first = tables.agg(F.min(run).alias("r")).scalar()
    return tables.withColumn("_r", first).where(F.col(run) == F.col("_r")).drop(run, "_r")


def run_manifest(runs: DataFrame, pattern_in: str, pattern_out: str) -> DataFrame:
    """One row per run and batch with input and output paths; ``runs`` holds run_id and batches ARRAY."""
    return runs.select("run_id", F.explode("batches").alias("batch")).select(
        "run_id", "batch", F.format_string(pattern_in, F.col("run_id")).alias("input_path"), F.format_string(pattern_out, F.col("batch")).alias("output_path"))


def empty_result(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows, with the declared columns: the result of an excluded batch."""
    return spark.createDataFrame([], schema)

"""The driver's tables in the roles of a count-matrix project.

cell = customer, batch = market segment, gene = part, splice tag from the return flag,
count = quantity; barcode = order, run = order priority; tags = event types of a user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import counts as C
from tallyloom.operators import qc

# Limits that suit the numbers in these tables.
CUTS = {"min_counts": 500, "min_feats": 20, "min_mito": 0.0, "max_mito": 0.25,
        "min_splice": 0.0, "max_splice": 0.6, "min_cells": 200}
RRNA = "ECONOMY"
MITO = "^red "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _splice():
    return F.when(F.col("l_returnflag") == "R", "S").when(F.col("l_returnflag") == "N", "U").otherwise("A")


def cell_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, gene_id, splice, count"""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("gene_id"), _splice().alias("splice"), F.col("l_quantity").alias("count"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cell_id"))
    return li.join(o, "l_orderkey").select("cell_id", "gene_id", "splice", "count")


def cell_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, batch for all customers"""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("batch"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch, cell_id, gene_id, splice, count"""
    return cell_counts(spark, sf_dir).join(cell_batches(spark, sf_dir), "cell_id").select(
        "batch", "cell_id", "gene_id", "splice", "count")


def gene_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch, cell_id, gene_id, count summed over splice tags"""
    return C.sum_splice(counts(spark, sf_dir), ("batch", "cell_id", "gene_id"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch, cell_id of every cell with a count (orders with a line)"""
    o = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    ids = o.select(F.col("o_custkey").alias("cell_id")).distinct()
    return ids.join(cell_batches(spark, sf_dir), "cell_id").select("batch", "cell_id")


def n_cells(spark: SparkSession, sf_dir: str, by: str = "batch") -> DataFrame:
    return cells(spark, sf_dir).groupBy(by).agg(F.count(F.lit(1)).alias("n_cells"))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("symbol"), F.col("p_brand").alias("chromosome"),
        F.col("p_type").alias("gene_type"), F.col("p_size").alias("start"), F.col("p_retailprice").alias("end"))
    return C.flag_mito_genes(p, MITO)


def barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, barcode, gene_id, splice, count"""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("barcode"), F.col("l_partkey").alias("gene_id"), _splice().alias("splice"),
        F.col("l_quantity").alias("count"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("barcode"), F.col("o_orderpriority").alias("run_id"))
    return li.join(o, "barcode").select("run_id", "barcode", "gene_id", "splice", "count")


def barcode_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, barcode, total, spliced, unspliced"""
    n = F.col("count")
    tag = F.col("splice")
    return barcodes(spark, sf_dir).groupBy("run_id", "barcode").agg(
        F.sum(n).cast("long").alias("total"),
        F.sum(F.when(tag == "S", n).otherwise(0.0)).cast("long").alias("spliced"),
        F.sum(F.when(tag == "U", n).otherwise(0.0)).cast("long").alias("unspliced"))


def qc_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch, cell_id and all quality metrics"""
    m = qc.cell_qc_metrics(cell_counts(spark, sf_dir), genes(spark, sf_dir), rrna=RRNA)
    return qc.qc_metrics(m).join(cell_batches(spark, sf_dir), "cell_id")


def cuts(spark: SparkSession, sf_dir: str, min_cells: int | None = None) -> DataFrame:
    limits = dict(CUTS) if min_cells is None else {**CUTS, "min_cells": min_cells}
    return qc.thresholds(cell_batches(spark, sf_dir).select("batch"), limits)


def filtered_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.filter_qc(qc_cells(spark, sf_dir), cuts(spark, sf_dir), qc.hard_limits(CUTS))


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pool_id, cell_id, hto_id, count: events per user and type, users spread over three pools"""
    return table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("pool"), (F.col("user_id") % 3).cast("string")).alias("pool_id"),
        F.col("user_id").alias("cell_id"), F.col("event_type").alias("hto_id")).agg(F.count(F.lit(1)).alias("count"))


def clustered_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, batch, cluster: nation as cluster of a customer, so that clusters cross batches"""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("batch"),
        F.concat(F.lit("cl"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("cluster"))


def embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, batch, cluster, is_dbl, embedding; the toxic flag of the document marks doublets"""
    flags = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("cell_id"), (F.col("toxic") == 1).alias("_dbl"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("cell_id"), F.col("lang").alias("batch"))
    return (
        table(spark, sf_dir, "embeddings")
        .select(F.col("vec_id").alias("cell_id"), F.concat(F.lit("cl"), F.col("label").cast("string")).alias("cluster"),
                F.col("embedding").cast("array<double>").alias("embedding"))
        .join(docs, "cell_id", "left").join(flags, "cell_id", "left")
        .select("cell_id", F.coalesce("batch", F.lit("none")).alias("batch"), "cluster", F.coalesce("_dbl", F.lit(False)).alias("is_dbl"), "embedding")
    )

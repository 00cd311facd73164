"""Gene annotations and gene sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def level_order(df: DataFrame, col: str, last: str | None = None) -> DataFrame:
    """Levels by decreasing frequency (then name), one of them forced to the end: level, ord."""
    n = df.groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    end = F.when(F.col("level") == last, 1).otherwise(0) if last is not None else F.lit(0)
    w = Window.orderBy(end, F.col("n").desc(), F.col("level"))  # one row per level
    return n.withColumn("ord", F.row_number().over(w).cast("long"))


def order_chromosomes(genes: DataFrame, last: str | None = None) -> DataFrame:
    """Add chromosome_ord: chromosomes with most genes first."""
    lv = level_order(genes, "chromosome", last).select(F.col("level").alias("chromosome"), F.col("ord").alias("chromosome_ord"))
    return genes.join(lv, "chromosome")


def _attribute(name: str):
    return F.nullif(F.regexp_extract("attributes", name + ' "([^"]*)"', 1), F.lit(""))


def gtf_genes(spark: SparkSession, path: str) -> DataFrame:
    """Genes of a GTF file: gene_id (symbol_ensembl), ids, type, position, width, chromosome order."""
    cols = ["chromosome", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"]
    raw = spark.read.csv(path, sep="\t", comment="#", quote="", schema=", ".join(f"`{c}` string" for c in cols))
    g = raw.where("feature = 'gene'").select(
        _attribute("gene_id").alias("ensembl_id"), _attribute("gene_name").alias("symbol"),
        F.coalesce(_attribute("gene_type"), _attribute("gene_biotype")).alias("gene_type"), "chromosome",
        (F.col("start").cast("long") - 1).alias("start"), F.col("end").cast("long").alias("end"), "strand")
    g = g.withColumn("symbol", F.coalesce("symbol", "ensembl_id")).withColumns({
        "width": F.col("end") - F.col("start") + 1, "gene_id": F.concat_ws("_", "symbol", "ensembl_id")})
    return order_chromosomes(g).orderBy("chromosome_ord", "start", "end").select(
        "gene_id", "ensembl_id", "symbol", "gene_type", "chromosome", "start", "end", "strand", "width", "chromosome_ord")


def read_gmt(spark: SparkSession, path: str, path_set: str | None = None) -> DataFrame:
    """Gene sets (name, description, genes ... by tabs) as path_set, pathway, symbol."""
    parts = F.split("value", "\t")
    x = spark.read.text(path).select(parts.getItem(0).alias("pathway"), F.explode(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0)))).alias("symbol"))
    return x.where("symbol <> ''").select(F.lit(path_set).alias("path_set"), "pathway", "symbol")

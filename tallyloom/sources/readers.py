"""Readers. Everything is read as distributed tables; nothing is parsed on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import make_key


def read_counts(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Long counts from parquet; with ``run_id`` adds run and the global ``cell_id`` run:barcode."""
    x = spark.read.parquet(path)
    if run_id is not None:
        x = x.withColumn("run_id", F.lit(run_id))
    return x.withColumn("cell_id", make_key("run_id", "barcode", sep=":")) if {"run_id", "barcode"} <= set(x.columns) else x


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of text files with their number from 0 within the file: file, line_no, value.

    Ids rise within a split; the splits' line counts (a few rows per file) give the offsets.
    """
    x = spark.read.text(path).select(F.input_file_name().alias("file"), "value", F.monotonically_increasing_id().alias("_id"))
    x = x.withColumn("_part", F.shiftright("_id", 33))
    parts = x.groupBy("file", "_part").agg(F.min("_id").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    return x.join(parts, ["file", "_part"]).select("file", (F.col("_id") - F.col("_lo") + F.col("_before")).alias("line_no"), "value")


def read_mtx(spark: SparkSession, mtx: str, rows: str, cols: str, run_id: str) -> DataFrame:
    """MatrixMarket triplets with their row (barcode) and column (feature) name files."""
    raw = numbered_lines(spark, mtx).where(~F.col("value").startswith("%"))
    head = raw.agg(F.min("line_no").alias("m")).scalar()  # the size line
    f = F.split(F.trim("value"), r"\s+")
    t = raw.withColumn("_h", head).where(F.col("line_no") > F.col("_h")).select(
        f.getItem(0).cast("long").alias("_i"), f.getItem(1).cast("long").alias("_j"), f.getItem(2).cast("double").alias("count"))

    def names(path: str, name: str, index: str) -> DataFrame:
        return numbered_lines(spark, path).select((F.col("line_no") + 1).alias(index), F.trim("value").alias(name))

    out = t.join(names(rows, "barcode", "_i"), "_i").join(names(cols, "feature", "_j"), "_j")
    return out.select(F.lit(run_id).alias("run_id"), "barcode", "feature", "count").where("count <> 0")


def read_table(spark: SparkSession, path, schema: str | None = None, sep: str = ",", header: bool = True, na: str = "", limit: int | None = None) -> DataFrame:
    """Delimited text (also gzip). Bad values become NULL. Without a schema types are inferred."""
    r = spark.read.option("header", header).option("sep", sep).option("nullValue", na).option("mode", "PERMISSIVE")
    df = r.schema(schema).csv(path) if schema else r.option("inferSchema", True).csv(path)
    return df.limit(limit) if limit is not None else df


def read_headerless(spark: SparkSession, path, names: Sequence[str], sep: str = ",") -> DataFrame:
    return spark.read.csv(path, sep=sep, schema=", ".join(f"`{n}` string" for n in names))


def scan_distinct(spark: SparkSession, path, cols: Sequence[str], sep: str = ",") -> DataFrame:
    return spark.read.csv(path, header=True, sep=sep).select(*cols).distinct()


def read_many(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """Union of many delimited files by name; columns missing in some are NULL, empty files add nothing."""
    out = None
    for p in paths:
        df = spark.read.csv(p, header=True, sep=sep)
        if not df.columns:
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("all files are empty")
    return out


def json_stats(spark: SparkSession, path: str, fields: Sequence[str], run: str = "run_id") -> DataFrame:
    """One row per JSON file with the listed numeric fields in order; absent fields are 0. The run is the file's stem."""
    raw = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+?)\.json$", 1).alias(run), "value")
    return raw.select(run, *[F.coalesce(F.get_json_object("value", f"$.{f}").cast("double"), F.lit(0.0)).alias(f) for f in fields])


def read_clean_batch(spark: SparkSession, path: str, batch: str, column: str = "batch") -> DataFrame:
    """One batch of a partitioned dataset; other partitions are not listed for reading."""
    return spark.read.parquet(path).where(F.col(column) == batch)


def whitelist_sets(spark: SparkSession, path: str, lookup: DataFrame) -> DataFrame:
    """Barcode whitelists per chemistry: (chemistry, gex_barcodes_f, barcode)."""
    lines = spark.read.text(path).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("gex_barcodes_f"), F.trim("value").alias("barcode"))
    return lookup.select("chemistry", "gex_barcodes_f").join(lines.where("barcode <> ''"), "gex_barcodes_f")

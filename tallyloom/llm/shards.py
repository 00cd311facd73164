"""Contiguous shards of nearly equal size from global prefix sums of bytes (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import ensure_checkpoint_dir

ROW_OVERHEAD = 16


def plan_shards(docs: DataFrame, n_shards: int, overhead: int = ROW_OVERHEAD) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into one of ``n_shards`` contiguous ranges of the id order.

    The rows, without their texts, are range-partitioned by (doc_id, crc32, size, row number). Totals of
    each partition give it its start in the global byte and row order; a running sum inside each partition
    does the rest. A row goes to the shard in which its middle byte falls when all bytes are cut at equal
    targets, so a shard's size is off its target by less than the largest row.

    Columns: doc_id, size, text_crc32, shard, slot (row number in the shard from 0), start (bytes before it).
    Null text has no bytes and checksum 0; null ids come first; equal rows are separate rows, neighbours
    in the order; an empty table gives no rows; other columns are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    slim = docs.select("doc_id", (F.octet_length(raw).cast("long") + overhead).alias("size"), F.crc32(raw).alias("text_crc32")).withColumn(
        "_row", F.monotonically_increasing_id())
    keys = ["doc_id", "text_crc32", "size", "_row"]
    # the written partitions fix what belongs to which range, whatever is computed again later
    placed = slim.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()).checkpoint()
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    totals = placed.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
        F.sum("_bytes").over(W.partitionBy()).alias("_total"),
    )
    inside = W.partitionBy("_part").orderBy(*keys).rowsBetween(W.unboundedPreceding, W.currentRow)
    run = placed.select("*", F.sum("size").over(inside).alias("_end"), F.row_number().over(inside).alias("_n")).join(starts, "_part")
    start = F.col("_byte0") + F.col("_end") - F.col("size")
    middle = (start * 2 + F.col("size")).cast("decimal(38,0)")
    cut = run.select(
        "doc_id", "size", "text_crc32",
        F.floor(middle * n_shards / (F.col("_total").cast("decimal(20,0)") * 2)).cast("int").alias("shard"),
        (F.col("_row0") + F.col("_n") - 1).alias("_at"), start.alias("start"))
    firsts = cut.groupBy("shard").agg(F.min("_at").alias("_first"))
    return cut.join(firsts, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("_at") - F.col("_first")).cast("long").alias("slot"), "start")


def write_shards(docs: DataFrame, plan: DataFrame, path: str) -> None:
    """Write the rows of ``docs`` (unique doc_id) as one folder per shard, in slot order."""
    rows = docs.join(plan.select("doc_id", "shard", "slot"), "doc_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

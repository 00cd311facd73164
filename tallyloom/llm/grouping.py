"""Deal documents into groups of bounded size that every pass over the texts meets again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def size_of(docs: DataFrame) -> tuple[int, int]:
    """(rows, UTF-8 bytes of text), for choosing numbers of groups and buckets."""
    r = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def deal(docs: DataFrame, n_bytes: int, group_bytes: int = 1 << 20, keep: list[str] | None = None) -> DataFrame:
    """(g, doc_id, text, and a struct of the columns ``keep``) hash-partitioned by group g; a group has about ``group_bytes`` of text.

    Groups grow slowly with the corpus (to 64 times the given size), so that what a group sends to a
    bucket stays a packet. The exchange is the same in every pass, so Spark reuses its files.
    """
    grown = min(64, max(1, n_bytes // (1 << 40)))
    n_groups = max(1, n_bytes // (group_bytes * grown))
    g = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups)).alias("g")
    n_parts = max(12, int(min(n_groups, -(-n_bytes // (24 << 20)))))
    rest = [F.struct(*[F.col(c) for c in keep]).alias("rest")] if keep else []
    return docs.select(g, F.col("doc_id").cast("long").alias("doc_id"), "text", *rest).repartition(n_parts, "g")

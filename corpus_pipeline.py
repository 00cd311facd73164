"""Clean a corpus of documents and pack it into training sequences, stage by stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import debruijn, decontam, langid, minhash, packing
from tallyloom.llm.queries import read, tokenizer_path
from tallyloom.session import cut_lineage, ensure_checkpoint_dir, ship_package

MAIN_SHARE = 0.5  # of a document's letters in its main language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, null texts included, and those in which no language has half of the letters."""
    ship_package(spark)
    judged = langid.identify(docs, langid.train(docs), docs.columns)
    return judged.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= MAIN_SHARE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of texts that share 80 % of their shingles of five words."""
    ship_package(spark)
    kept = minhash.near_duplicates(docs, width=5, percent=80).where("kept").select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words of passages of 20 words or more that came earlier. Untouched texts stay as they are;
    n_chars follows the text. A document of which nothing is left stays as an empty one."""
    ship_package(spark)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = debruijn.dedup_words(docs, keep=rest)
    cols = {c: F.col(f"rest.`{c}`") for c in rest} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(cols["n_chars"])
    return cut.select(*[cols[c].alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item, maybe edited."""
    ship_package(spark)
    # few ids; written first, so that Spark knows their size and need not send all texts to meet them
    leaks = cut_lineage(decontam.find_leaks(docs, read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_leak")).distinct())
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("_leak")), "left_anti")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path()).drop("ids")


STAGES = [("language ID", language), ("MinHash near-dedup", near_duplicates), ("substring dedup", repeated_passages), ("decontamination", benchmark_leaks), ("best-fit packing", sequences)]
ORACLE_SQL = None  # the tokenizer and the language model have no SQL; tests hold each stage against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{at}/{i}")
            docs = spark.read.parquet(f"{at}/{i}")
    return docs

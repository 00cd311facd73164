"""Both removers of repeated passages against plain versions."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import debruijn, suffix_dedup

SF = "/root/testdata/sf0.001"
SMALL = {"group_bytes": 1 << 13, "bucket_bytes": 1 << 15}


def made(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    words = ["aa", "b", "cé", "dd", "the", "of\t", "x" * 30, "　z"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120))) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [rnd.choice(base)[rnd.randint(0, 80) :][: rnd.randint(0, 400)] for _ in range(rnd.randint(0, 4))]
        rows.append((i * 7 % 60, " ".join(parts)))
    rows += [(100, None), (101, ""), (102, "one"), (103, "the " * 3000), (104, "the " * 3000), (105, "a" * 5000), (106, "a" * 49), (107, "a" * 50)]
    return rows


def bytes_of(df, **kw):
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in suffix_dedup.dedup_bytes(df, **kw).select(*cols).collect()), key=str)


def words_of(df, **kw):
    return sorted((tuple(r) for r in debruijn.dedup_words(df, **kw).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_made_rows(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert bytes_of(df, **SMALL, batch=500) == brute.dedup_bytes(rows)
    assert words_of(df, **SMALL) == brute.dedup_words(rows)


def test_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert bytes_of(df, group_bytes=1 << 15) == brute.dedup_bytes(rows)
    assert words_of(df, group_bytes=1 << 15) == brute.dedup_words(rows)


def test_same_and_null_ids(spark):
    text = "one passage of more than fifty bytes that every one of these rows has in it " * 2
    rows = [(None, text), (None, text), (5, text), (5, text + "more"), (5, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("g", F.lit("x")).withColumn("row", F.lit(1))
    assert bytes_of(df) == brute.dedup_bytes(rows)  # rows of one id leave each other alone
    assert sum(r[1] - r[2] for r in words_of(df)) < sum(r[1] for r in words_of(df)) / 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bytes_of(df) == [] and words_of(df) == []


def test_levels_merge_geometrically():
    import numpy as np

    family = suffix_dedup.SuffixLevels(2)
    for i in range(64):
        family.add(np.array([f"{i:02d}".encode()], "S2"), np.array([i]))
    assert len(family.levels) <= 7
    assert family.add(np.array([b"05"], "S2"), np.array([99])).tolist() == [5]


@pytest.mark.parametrize("hot", [0, 5])
def test_hot_minimisers_are_judged_alike(spark, hot):
    rows = made(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert bytes_of(df, **SMALL, batch=500, hot=hot) == brute.dedup_bytes(rows)


def test_one_line_in_every_document(spark, monkeypatch):
    from pyspark.sql.group import GroupedData

    met = {}
    real = GroupedData.applyInArrow
    monkeypatch.setattr(GroupedData, "applyInArrow", lambda self, fn, schema: met.update({fn.__name__: self._df}) or real(self, fn, schema))
    one = F.concat(F.sha2(F.concat(F.lit("a"), F.col("id")), 256), F.lit(" one common line of 30 bytes.. "), F.sha2(F.concat(F.lit("b"), F.col("id")), 256))
    suffix_dedup.dedup_bytes(spark.range(90_000).select(F.col("id").alias("doc_id"), one.alias("text")))
    most, total = met["judge_strings"].groupBy("bucket").agg(F.sum(F.length("payload")).alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert total > 90_000 * 40 and most < total / 4  # no suffix array has what one minimiser holds

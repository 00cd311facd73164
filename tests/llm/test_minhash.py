"""Near-duplicate components against all pairs."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import minhash


def got(df, **kw):
    return sorted(tuple(r) for r in minhash.near_duplicates(df, **kw).select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(df) == brute.near_duplicates([(r["doc_id"], r["text"]) for r in df.collect()])


def test_edited_copies(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(160)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):  # chains of edits: similarities from 0.5 to 1
        w = list(base if i % 3 else rows[rnd.randint(0, i - 1)][1].split())
        for _ in range(rnd.randint(0, 9)):
            w[rnd.randint(0, len(w) - 1)] = f"w{rnd.randint(0, 5000)}"
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, " \t\n"), (202, "One two"), (203, "one TWO"), (204, "one two three"), (205, "one\ttwo  three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("label", F.lit("x"))
    assert got(df) == brute.near_duplicates(rows)
    assert got(df, width=5) == brute.near_duplicates(rows, 5)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (None, "x")], "doc_id long, text string")
    rows = {tuple(r) for r in minhash.near_duplicates(df).select("doc_id", "component_id", "kept").collect()}
    assert rows == {(None, 7, False), (7, 7, True), (None, None, True)}
    assert minhash.near_duplicates(df.where("false")).count() == 0


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 1 << 62, 3000).astype(np.uint64)
    a, b = x[:2000], x[500:2500]  # 1500 of 2500 shared
    s = minhash.signatures(np.concatenate([a, b]), np.array([0, 2000]), 1024)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.06


def test_signatures_travel_only_with_those_that_meet(spark):
    """Rows of buckets carry no signatures or sets; what stubborn buckets send is theirs alone."""
    sig = bytes(512)
    members = spark.createDataFrame([(b * 32, r, 9, r if b else 1) for b in range(2) for r in range(1, 4)], "bucket long, rep long, n long, label long")
    features = spark.createDataFrame([(r, sig, np.arange(9, dtype=np.uint64).tobytes()) for r in range(1, 9)], "rep long, sig binary, items binary")
    busy = minhash.stubborn_links(members, features.drop("items"), 32, 4, 80)
    assert {tuple(r) for r in busy.collect()} == {(32, 1), (32, 2), (32, 3)}
    links = minhash.stubborn_links(members, features, 32, 4, 80, block=2)
    found = {tuple(r) for r in links.collect()}
    assert {x for link in found for x in link} == {1, 2, 3} and all(a < b for a, b in found)
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert sorted(map(tuple, minhash.likely(pairs, features.drop("items"), 80).collect())) == [(1, 2), (2, 3)]

"""Nearest neighbours: recall against brute force, exact scores, ties and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import ann
from tallyloom.llm.queries import QUERIES


def brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(1))
        out[q] = [(ids[i], d[i]) for i in sorted(range(len(ids)), key=lambda i: (d[i], ids[i])) if ids[i] != q][:k]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(got) + 1
        got.append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("table", ["sf0.1", "hot"])
def test_recall(spark, table, tmp_path):
    sf = f"/root/testdata/{table}"
    if table == "hot":  # one vector and its near copies hold a third of the rows
        sf = str(tmp_path)
        rng = np.random.default_rng(7)
        hot = rng.normal(size=64)
        x = [hot + (i % 7) * 1e-3 * rng.normal(size=64) if i % 3 == 0 else rng.normal(size=64) for i in range(6000)]
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").write.parquet(f"{sf}/embeddings.parquet")
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    want = brute(ids, x, [i for i in ids if i % 100 == 0])
    got = results(QUERIES["op4_adaptive_dimension_ann"](spark, sf))
    assert got.keys() == want.keys()
    place = {i: n for n, i in enumerate(ids)}
    hits = 0
    for q, rows in got.items():
        assert len(rows) == 10 and rows == sorted(rows, key=lambda r: (r[1], r[0]))
        for i, s in rows:
            assert abs(s - np.sqrt(((x[place[i]] - x[place[q]]) ** 2).sum())) < 1e-12
        hits += len({i for i, _ in rows} & {i for i, _ in want[q]})
    assert hits >= 0.95 * 10 * len(want)


def test_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 8)).tolist()
    rows = [(i, base[i % 30]) for i in range(300)]  # ten copies of each
    odd = [(300, None), (400, [0.0] * 8), (500, [float("nan")] + [1.0] * 7), (600, [None] + [1.0] * 7), (700, [float("inf")] + [1.0] * 7), (800, [1.0]), (None, base[0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("list", F.lit("x")).withColumn("score", F.lit(1))
    got = results(ann.search(df, df.where("vec_id % 100 = 0"), recall=1.0))
    want = brute(list(range(300)), np.array([r[1] for r in rows]), [0, 100, 200])
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [4.0, 2.0])], "vec_id long, embedding array<float>")
    got = results(ann.search(df, df.where("vec_id = 0")))
    assert [i for i, _ in got[0]] == [1, 2]
    assert ann.search(df.where("false"), df.where("false")).count() == 0

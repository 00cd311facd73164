"""Neighbour descent: recall against brute force on tables of three kinds, exact distances, odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import descent


def brute(x, k):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    return d, np.lexsort((np.broadcast_to(np.arange(len(x)), d.shape), d), axis=1)[:, :k]


def vectors(kind, n):
    rng = np.random.default_rng(1)
    if kind == "clusters":
        return rng.normal(size=(12, 20))[rng.integers(0, 12, n)] * 3 + rng.normal(size=(n, 20))
    if kind == "line":  # a curve that runs through many leaves
        t = np.sort(rng.uniform(0, 20, n))
        return np.column_stack([np.sin(t), np.cos(t), t, *(rng.normal(0, 0.05, n) for _ in range(5))])
    x = rng.normal(size=(n, 8))  # a third of all rows next to one place
    x[::3] = x[0] + 1e-3 * rng.normal(size=(len(x[::3]), 8))
    return x


@pytest.mark.parametrize("kind, n", [("clusters", 3000), ("line", 1500), ("hot", 2000)])
def test_recall(spark, kind, n):
    x, k = vectors(kind, n), 10
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell_id long, embedding array<double>")
    got = descent.knn_descent(df, k, block_rows=150).toPandas().sort_values(["cell_id", "rank"])
    d, want = brute(x, k)
    assert len(got) == n * k and (got["rank"].to_numpy().reshape(n, k) == np.arange(1, k + 1)).all()
    found = got["neighbour"].to_numpy().reshape(n, k)
    assert all(len(set(r)) == k for r in found) and not (found == np.arange(n)[:, None]).any()
    assert np.allclose(got["distance"], d[got["cell_id"], got["neighbour"]], rtol=1e-9)
    recall = np.mean([len(set(a) & set(b)) / k for a, b in zip(found, want)])
    print(kind, n, recall)
    assert recall > 0.95


def test_small_and_odd_tables(spark):
    df = spark.createDataFrame([("a", [0.0]), ("b", [1.0]), ("c", [1.0]), ("d", None)], "cell_id string, embedding array<double>").withColumn("block", F.lit(1))
    got = [tuple(r) for r in descent.knn_descent(df, 15).orderBy("cell_id", "rank").collect()]
    assert got == [("a", "b", 1.0, 1), ("a", "c", 1.0, 2), ("b", "c", 0.0, 1), ("b", "a", 1.0, 2), ("c", "b", 0.0, 1), ("c", "a", 1.0, 2)]
    assert descent.knn_descent(df.limit(0)).count() == 0
    assert descent.knn_descent(df.limit(1)).count() == 0

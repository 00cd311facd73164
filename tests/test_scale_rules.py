"""What must hold whatever the size: no lost rows, no prefixes, no caps."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import stats
from tallyloom.operators import counts, demux, embed, joins, labels, ordered


def nb_cdf(k, m, s):
    p = s / (s + m)
    return sum(math.exp(math.lgamma(i + s) - math.lgamma(s) - math.lgamma(i + 1) + s * math.log(p) + i * math.log1p(-p)) for i in range(k + 1))


def test_negative_binomial_quantile():
    for m, s in ((0.5, 2.0), (3.0, 1e6), (40.0, 0.3), (2000.0, 5.0)):
        for q in (0.05, 0.5, 0.9, 0.99):
            k = int(stats.nb_quantile([m], [s], [q])[0])
            assert nb_cdf(k, m, s) >= q - 1e-9 and (k == 0 or nb_cdf(k - 1, m, s) < q + 1e-9)
    assert stats.nb_quantile([0.0], [1.0], [0.9])[0] == 0


@pytest.mark.parametrize("tie", ["id - 5000", "concat('run1:', lpad(id, 5, '0'))"])
def test_positions_of_one_hot_value(spark, tie):
    df = spark.range(10000).selectExpr(f"{tie} AS tie", "CASE WHEN id < 9000 THEN 1.0 ELSE id END AS v", "'a' AS g")
    got = [r["tie"] for r in ordered.positions(df, "g", "v", "tie", descending=False).orderBy("position").collect()]
    want = sorted(df.collect(), key=lambda r: (r["v"], r["tie"]))
    assert got == [r["tie"] for r in want]


def test_pieces_of_values_far_from_zero(spark):
    df = spark.range(5000).select((F.col("id") + 10**12).alias("v"), F.lit(1).alias("n"), F.lit("a").alias("g"))
    pieces = ordered._cut_in_pieces(df, ["g"], "v", 64).groupBy("_piece").count()
    assert pieces.count() > 20


def test_cells_without_a_selected_gene_keep_a_vector(spark):
    logs = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (3, "z", 1.0)], "cell_id long, gene_id string, logcount double")
    genes = spark.createDataFrame([("a",), ("b",)], "gene_id string")
    cells = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "cell_id long")
    got = {r["cell_id"]: r["features"].toArray() for r in embed.scaled_vectors(logs, genes, cells).collect()}
    x = np.array([[1, 2], [3, 0], [0, 0], [0, 0]], float)
    want = (x - x.mean(0)) / x.std(0, ddof=1)
    assert np.allclose([got[i] for i in (1, 2, 3, 4)], want)


def test_neighbours_stay_within_groups(spark):
    rng = np.random.default_rng(1)
    x, g = rng.normal(size=(300, 5)), [random.Random(i).choice("ab") for i in range(300)]
    df = spark.createDataFrame([(i, g[i], x[i].tolist()) for i in range(300)], "cell_id long, batch string, embedding array<double>")
    got = {}
    for r in embed.knn(df, 4, by="batch", block_rows=25).collect():
        got.setdefault(r["cell_id"], {})[r["rank"]] = r["neighbour"]
    for i in range(300):
        d = sorted((np.sqrt(((x[i] - x[j]) ** 2).sum()), j) for j in range(300) if j != i and g[j] == g[i])
        assert [got[i][n] for n in (1, 2, 3, 4)] == [j for _, j in d[:4]]


@pytest.mark.parametrize("n", [20, 90, 400])
def test_batch_correction_keeps_cells_and_moves_batches_together(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, "x" if i % 2 else "y", (rng.normal(size=4) + (0.0 if i % 2 else 1.5)).tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "cell_id long, batch string, embedding array<double>")
    out = embed.batch_correct(df).collect()
    assert sorted(r["cell_id"] for r in out) == list(range(n))
    gap = lambda rows: np.linalg.norm(np.mean([r[2] for r in rows if r[1] == "x"], 0) - np.mean([r[2] for r in rows if r[1] == "y"], 0))
    assert gap([tuple(r) for r in out]) < gap(rows)


def test_tags_of_two_pools(spark):
    rng = np.random.default_rng(3)
    rows = []
    for pool, tags in (("p", ["A", "B"]), ("q", ["C", "D", "E"])):
        for c in range(240):
            own = {tags[c % len(tags)]} if c % 12 else set(tags[:2])
            rows += [(pool, c, t, int(rng.poisson(300 if t in own else 3))) for t in tags]
    df = spark.createDataFrame(rows, "pool_id string, cell_id long, hto_id string, count long")
    got = demux.hto_demux(df, 0.999).collect()
    right = 0
    for r in got:
        tags = ["A", "B"] if r["pool_id"] == "p" else ["C", "D", "E"]
        want = tags[r["cell_id"] % len(tags)] if r["cell_id"] % 12 else "_".join(tags[:2])
        right += r["hto_classification"] == want
    assert len(got) == 480 and right > 460


def test_grid_has_every_combination(spark):
    df = spark.range(400).selectExpr("id % 37 AS a", "id % 11 AS b", "1 AS n").distinct().where("a + b < 30")
    full = joins.complete(df, ["a"], ["b"], {"n": 0})
    assert full.count() == full.select("a", "b").distinct().count() == df.select("a").distinct().count() * df.select("b").distinct().count()
    assert full.agg(F.sum("n")).first()[0] == df.count()


def test_classes_of_cells_without_counts(spark):
    logs = spark.createDataFrame([(1, "a", 2.0), (2, "b", 1.0)], "cell_id long, gene_id string, logcount double")
    model = spark.createDataFrame([("x", "a", 1.0), ("y", "a", -1.0), ("y", "b", 3.0)], "class string, gene_id string, weight double")
    icpt = spark.createDataFrame([("x", 0.5), ("y", 0.4)], "class string, intercept double")
    cells = spark.createDataFrame([(1,), (2,), (3,)], "cell_id long")
    got = {r["cell_id"]: r["predicted_label"] for r in labels.classify_cells(logs, model, icpt, cells=cells).collect()}
    assert got == {1: "x", 2: "y", 3: "x"}
    scaling = spark.createDataFrame([("a", 3.0, 2.0)], "gene_id string, centre double, scale double")
    got = {r["cell_id"]: r["predicted_label"] for r in labels.classify_cells(logs, model, icpt, cells=cells, scaling=scaling).collect()}
    assert got == {1: "y", 2: "y", 3: "y"}  # zeros are centred as well


def test_no_gene_left_is_an_error(spark):
    c = spark.createDataFrame([("a", 1)], "gene_id string, count long")
    with pytest.raises(ValueError):
        counts.keep_genes(c, spark.createDataFrame([("b",)], "gene_id string"))

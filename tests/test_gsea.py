"""Enrichment p-values by level splitting and the conditional collapsing of sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import gsea as G


def test_deviations_match_a_walk():
    rng = np.random.default_rng(0)
    w = rng.random(60)
    at = G.draw_sets(rng, 200, 60, 7)
    assert (np.diff(at, axis=1) > 0).all()
    high, low = G.deviations(at, w)
    for row, h, lo in zip(at, high, low):
        run = np.cumsum([w[i] / w[row].sum() if i in row else -1 / 53 for i in range(60)])
        assert h == pytest.approx(max(run)) and lo == pytest.approx(min(0, min(run)), abs=1e-12)
    assert (np.diff(G.draw_sets(rng, 50, 10, 9), axis=1) > 0).all()


def test_tails_agree_with_a_million_draws():
    rng = np.random.default_rng(1)
    w = np.abs(np.sort(rng.normal(size=400))[::-1])
    size, scores = 12, np.array([0.55, 0.65, 0.72])
    high, low = (np.concatenate(x) for x in zip(*(G.deviations(G.draw_sets(rng, 100_000, 400, size), w) for _ in range(10))))
    plain = np.array([((high >= s) & (high >= -low)).mean() for s in scores])
    assert plain[2] < 1e-3 and plain[2] * 1e6 > 20
    runs = np.array([G.split_levels(w, size, scores, np.random.default_rng([2, i]))[0] for i in range(6)])
    level = G.split_levels(w, size, scores, np.random.default_rng(3))[1]
    one = float(G.D.trigamma(np.array([51.0]))[0] - G.D.trigamma(np.array([102.0]))[0])
    stated = np.sqrt((level + 1) * one / len(runs))
    count_error = 1 / np.sqrt(plain * 1e6)
    assert (np.abs(np.log(runs.mean(0) / plain)) < 4 * np.sqrt(stated**2 + count_error**2)).all()


def ranks_of(spark, n=600):
    return spark.createDataFrame([("a", f"g{i:04d}", float(n / 2 - i) / 100) for i in range(n)], "cluster string, symbol string, stat double")


def test_tiny_p_values(spark):
    ranks = ranks_of(spark)
    sets = spark.createDataFrame([(s, f"g{i:04d}") for s, ids in {"top": range(25), "bottom": range(575, 600), "spread": range(0, 600, 24)}.items() for i in ids], "pathway string, symbol string")
    got = {r["pathway"]: r for r in G.gsea(ranks, sets).collect()}
    assert got["top"]["pval"] < 1e-12 and got["bottom"]["pval"] < 1e-12 and got["spread"]["pval"] > 0.05
    assert got["top"]["es"] > 0.9 and got["bottom"]["es"] < -0.9 and 0 < got["top"]["log2err"] < 3 and got["top"]["padj"] < 1e-10


def test_collapsing(spark):
    """A set inside a better one goes, one of its own stays, and so does one that adds a signal of its own to a shared part."""
    ranks = ranks_of(spark)
    sets = {"large": range(40), "inner": range(0, 40, 3), "noisy": [*range(0, 40, 2), *range(60, 600, 14)], "low": range(560, 600), "both": [*range(20, 40), *range(40, 70)]}
    df = spark.createDataFrame([(s, f"g{i:04d}") for s, ids in sets.items() for i in ids], "pathway string, symbol string")
    res = G.gsea(ranks, df)
    out = {r["pathway"]: r for r in G.collapse_pathways(res, ranks, df).collect()}
    assert {s for s in sets if out[s]["padj"] < 0.05} >= {"large", "inner", "low", "both"}
    assert out["large"]["main_path"] and out["low"]["main_path"] and out["both"]["main_path"]
    assert not out["inner"]["main_path"] and not out["noisy"]["main_path"]
    assert G.collapse_pathways(res.withColumn("padj", F.lit(1.0)), ranks, df).where("main_path").count() == 0


def test_walk_of_main_sets(spark):
    rng = np.random.default_rng(4)
    n = 40
    links = {(int(a), int(b)) for a, b in rng.integers(0, n, (90, 2)) if a != b}
    parent = {}
    for i in range(n):
        if i not in parent:
            for a, b in links:
                if a == i and b not in parent:
                    parent[b] = i
    order = spark.createDataFrame([("a", f"s{i}", i) for i in range(n)], "cluster string, pathway string, n long")
    covers = spark.createDataFrame([("a", f"s{a}", f"s{b}", 1.0) for a, b in links], "cluster string, pathway string, other string, min_p double")
    got = {r["pathway"]: r["main_path"] for r in G.main_sets(order, covers).collect()}
    assert got == {f"s{i}": i not in parent for i in range(n)}

"""Planted signals for operators without an SQL counterpart, and brute-force checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import stats as S
from tallyloom.operators import ambient, checks, demux, embed, graph, gsea, hvg, markers
from tallyloom.operators import pseudobulk as P


def blobs(spark, n=90, shift=0.0, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.normal(0, 0.3, 4) + (6 if i % 3 == 0 else 0) * np.array([1, 0, 0, 0]) + (6 if i % 3 == 1 else 0) * np.array([0, 1, 0, 0])
        b = "b1" if i % 2 else "b0"
        rows.append((i, b, i % 3, (x + (shift if b == "b1" else 0) * np.array([0, 0, 1, 0])).tolist()))
    return spark.createDataFrame(rows, "cell_id long, batch string, truth int, embedding array<double>")


def test_knn_with_regions_and_blocks_is_exact(spark):
    e = blobs(spark, 120)
    got = {}
    for r in embed.knn(e.select("cell_id", "embedding"), 5, n_regions=4, block_rows=15).collect():
        got.setdefault(r["cell_id"], []).append((r["rank"], r["neighbour"]))
    p = e.toPandas()
    x = np.stack(p["embedding"])
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    for i in range(len(p)):
        assert [n for _, n in sorted(got[i])] == np.argsort(d[i], kind="stable")[:5].tolist()


def test_graph_clusters_find_blobs(spark):
    e = blobs(spark)
    nn = embed.knn(e.select("cell_id", "embedding"), 8)
    c = graph.graph_clusters(nn, [0.3]).join(e, "cell_id").toPandas()
    assert c.groupby("RNA_snn_res.0.3")["truth"].nunique().max() == 1


def test_batch_correction_closes_the_gap(spark):
    e = blobs(spark, shift=2.0)
    out = embed.batch_correct(e.select("cell_id", "batch", "embedding"), n_clusters=3, n_rounds=2).join(e.select("cell_id", "truth"), "cell_id").toPandas()
    x = np.stack(out["embedding"])
    gap = abs(x[(out["batch"] == "b0").to_numpy(), 2].mean() - x[(out["batch"] == "b1").to_numpy(), 2].mean())
    assert gap < 0.8


def test_tags_recover_samples(spark):
    rng = np.random.default_rng(3)
    rows, truth = [], {}
    for c in range(120):
        own = c % 4
        kind = "doublet" if c % 20 == 0 else "singlet"
        truth[c] = kind
        for t in range(4):
            hot = t == own or (kind == "doublet" and t == (own + 1) % 4)
            rows.append(("p", c, f"t{t}", int(rng.poisson(200 if hot else 3)) + 1))
    tags = spark.createDataFrame(rows, "pool_id string, cell_id long, hto_id string, count long")
    out = {r["cell_id"]: (r["demux_class"], r["guess"]) for r in demux.hto_demux(tags).collect()}
    assert np.mean([out[c][0] == truth[c] for c in truth]) > 0.9
    assert all(out[c][1] == f"t{c % 4}" for c in truth if truth[c] == "singlet")


def test_loess_recovers_trend(spark):
    rng = np.random.default_rng(5)
    mean = np.exp(rng.normal(0, 1.5, 400))
    var = mean + 0.1 * mean**2
    rows = [("b", i, 100, float(m), float(v)) for i, (m, v) in enumerate(zip(mean, var))] + [("b", 999, 100, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "batch string, gene_id long, n_cells long, mean double, variance double")
    out = hvg.variance_trend(df).toPandas().set_index("gene_id")
    assert np.abs(out.loc[range(400), "estimated_variance"] - np.log10(var)).max() < 0.05
    assert out.loc[999, "estimated_variance"] == 0 and out.loc[999, "reg_std"] == 1


def test_planted_marker_is_found(spark):
    rng = np.random.default_rng(7)
    pb, n = [], []
    for c in ("a", "b", "c"):
        for s in range(6):
            n.append((c, f"s{s}", 50))
            for g in range(60):
                mu = 40 * (8 if (g == 5 and c == "a") else 1)
                pb.append((c, f"s{s}", g, float(rng.poisson(mu))))
    pb = spark.createDataFrame(pb, "cluster string, batch string, gene_id long, count double").where("count > 0")
    n = spark.createDataFrame(n, "cluster string, batch string, n_cells long")
    genes = spark.createDataFrame([(g, f"g{g}", "protein_coding") for g in range(60)], "gene_id long, symbol string, gene_type string")
    out = markers.markers_from_pseudobulk(pb, n, genes, 10).where("cluster = 'a'").orderBy("PValue").first()
    assert out["gene_id"] == 5 and out["logFC"] > 2.5 and out["FDR"] < 0.01


def test_planted_pathway_and_no_edge_loss(spark):
    rows = [("a", f"g{i:03d}", float(200 - i)) for i in range(200)]
    ranks = spark.createDataFrame(rows, "cluster string, symbol string, stat double")
    sets = spark.createDataFrame([("up", f"g{i:03d}") for i in range(10)] + [("mixed", f"g{i:03d}") for i in range(5, 200, 20)], "pathway string, symbol string")
    out = {r["pathway"]: r for r in gsea.gsea(ranks, sets, 200).collect()}
    assert out["up"]["es"] > 0.9 and out["up"]["padj"] < 0.05 and len(out["up"]["leading_edge"]) == 10
    assert out["mixed"]["pval"] > 0.05


def test_empty_drops_and_decontamination(spark):
    rng = np.random.default_rng(11)
    amb = np.full(30, 1 / 30)
    cell = np.r_[np.full(5, 0.19), np.full(25, 0.05 / 25)]
    rows, ranks = [], []
    for b in range(120):
        is_cell = b < 20
        total = 60 if is_cell else 20 if b < 40 else 10
        for g, c in enumerate(rng.multinomial(total, cell if is_cell else amb)):
            if c:
                rows.append(("r", f"b{b:03d}", g, "S", float(c)))
        ranks.append(("r", f"b{b:03d}", 1000, not is_cell and b >= 40))
    counts = spark.createDataFrame(rows, "run_id string, barcode string, gene_id long, splice string, count double")
    rk = spark.createDataFrame(ranks, "run_id string, barcode string, knee1 long, in_empty_plateau boolean")
    called = {r["barcode"] for r in ambient.empty_drops(counts, rk, 1000, fdr=0.01).where("is_cell").collect()}
    assert {f"b{b:03d}" for b in range(20)} <= called and len(called) <= 22
    cl = counts.where("barcode < 'b020'").select("run_id", "barcode", F.lit("c1").alias("cluster")).distinct()
    emp = counts.where("barcode >= 'b040'").groupBy("run_id", "gene_id").agg(F.sum("count").alias("count"))
    clean, st = ambient.decontaminate(counts.where("barcode < 'b020'"), cl, emp, 4)
    assert st.where("contamination < 0 OR contamination > 1").count() == 0
    assert clean.where("gene_id < 5").agg(F.sum("count")).first()[0] > 0.8 * counts.where("barcode < 'b020' AND gene_id < 5").agg(F.sum("count")).first()[0]


def test_tails():
    # known values: t(2.0, 10 df) upper tail, NB quantile of mean 3, size 2
    assert S.t_upper(np.array([2.0]), np.array([10.0]))[0] == pytest.approx(0.03669402, abs=1e-7)
    assert S.ln_gamma(np.array([10.0]))[0] == pytest.approx(np.log(362880.0))
    assert S.nb_quantile([0.0], [1.0], 0.99)[0] == 0


def test_filter_by_expression_and_complete(spark):
    pb = spark.createDataFrame([("a", "s1", 1, 10.0), ("b", "s1", 2, 5.0)], "cluster string, batch string, gene_id long, count double")
    assert P.complete_pseudobulk(pb).count() == 4


def test_gate(spark):
    with pytest.raises(checks.CheckFailed):
        checks.gate(spark.range(1), "one row")
    checks.gate(spark.range(0), "none")

"""Stages: quality control, variable genes, integration, markers, labels, subset re-analysis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import ambient as A
from tallyloom.operators import checks, demux, embed, graph, gsea, hvg, labels, markers, qc, ranks
from tallyloom.operators import counts as C
from tallyloom.operators import pseudobulk as P
from tallyloom.session import cut_lineage

# Fixed value: variable genes that a component space is made of.
N_HVGS = 2000


@dataclass(frozen=True)
class QcResult:
    cells: DataFrame
    status: DataFrame


def mapping(barcode_totals: DataFrame, lowers: Sequence[int] = ranks.FIRST_LOWERS, low_count: str | int = "shin2") -> DataFrame:
    """Barcode table with ranks, knees, droplet parameters and the empty plateau."""
    return ranks.barcode_table(barcode_totals, lowers, low_count=low_count)


def ambient(counts: DataFrame, barcode_table: DataFrame, method: str = "rank") -> DataFrame:
    """Called barcodes: by rank, or by the test against the empty profile."""
    if method == "rank":
        return ranks.call_cells_by_rank(barcode_table).select("run_id", "barcode")
    return A.empty_drops(counts, barcode_table).where("is_cell").select("run_id", "barcode")


def demultiplex(tags: DataFrame, expected: DataFrame, quantile: float = 0.99) -> DataFrame:
    """Tag assignment per cell after the signal checks."""
    checks.gate(checks.tag_signal(tags, expected), "expected tags with very low counts")
    low = demux.check_tags(tags, expected).where("status = 'drop'").select("pool_id", "hto_id")
    return demux.hto_demux(tags.join(low, ["pool_id", "hto_id"], "left_anti"), quantile)


def run_qc(counts: DataFrame, genes: DataFrame, batches: DataFrame, defaults: Mapping[str, float], custom: DataFrame | None = None,
           classes: DataFrame | None = None, demux_type: str = "none", failed_batches: DataFrame | None = None, rrna: str = C.RRNA_TYPE) -> QcResult:
    """Cell metrics, kept cells and batch status. ``batches`` is (cell_id, batch), ``classes`` has doublet and tag classes."""
    cells = qc.qc_metrics(qc.cell_qc_metrics(counts, genes, rrna=rrna)).join(batches, "cell_id")
    eligible = None
    if classes is not None:
        cells = cells.join(classes, "cell_id", "left")
        eligible = qc.singlet_predicate(demux_type, True)
    cuts = qc.thresholds(batches.select("batch"), defaults, custom)
    kept = cut_lineage(qc.filter_qc(cells, cuts, qc.hard_limits(defaults), eligible=eligible))
    status = qc.sample_qc_stats(kept, cuts, failed_batches=failed_batches)
    return QcResult(kept, cut_lineage(status))


def find_hvgs(gene_sums: DataFrame, cells: DataFrame, n: int = N_HVGS, method: str = "sample", groups: DataFrame | None = None,
              exclude: DataFrame | None = None, trend: str = "loess") -> DataFrame:
    """Variable genes by batch (``sample``), over all cells (``all``) or by groups of batches (``groups``: batch, group)."""
    ids = cells.select("cell_id", "batch")
    if method == "all":
        ids = ids.withColumn("group", F.lit("all"))
    elif method == "groups":
        ids = ids.join(groups.select("batch", "group"), "batch")
    by = "batch" if method == "sample" else "group"
    src = gene_sums.drop(*[c for c in ("batch", "group") if c in gene_sums.columns]).join(ids, "cell_id")
    n_cells = ids.groupBy(by).agg(F.count(F.lit(1)).alias("n_cells"))
    out = cut_lineage(hvg.highly_variable_genes(hvg.gene_variances(src, n_cells, by, trend=trend), n, by, exclude))
    none = out.where("false").select("gene_id")
    checks.gate(checks.hvg_selection(out, none if exclude is None else exclude, n), "selected genes")
    return out


def integrate_once(gene_sums: DataFrame, cells: DataFrame, hvgs: DataFrame, resolutions: Sequence[float], n_dims: int = 50, theta: float = 0.1,
                   k: int = embed.N_NEIGHBOURS, libs: DataFrame | None = None, correct: bool = True) -> DataFrame:
    """One pass: normalise, scale, components, batch correction, neighbours, clusters.

    The result has cell_id, batch, embedding and one cluster column per resolution.
    """
    ids = cells.select("cell_id", "batch")
    src = gene_sums.drop("batch") if "batch" in gene_sums.columns else gene_sums
    src = src.join(ids.select("cell_id"), "cell_id", "left_semi")
    logs = C.log_normalise(hvg.hvg_counts(src, hvgs, ids), libs if libs is not None else C.library_sizes(src))
    picked = hvgs.where("highly_variable").select("gene_id")
    emb = embed.pca(cut_lineage(embed.scaled_vectors(logs, picked, ids)), n_dims).join(ids, "cell_id")
    if correct:
        emb = embed.batch_correct(emb, theta=theta)
    emb = cut_lineage(emb)
    lost = ids.join(emb.select("cell_id"), "cell_id", "left_anti")
    checks.gate(lost, "cells without an embedding")
    checks.gate(checks.nan_embeddings(emb), "missing values in the embedding")
    nn = cut_lineage(embed.knn(emb.select("cell_id", "embedding"), k))
    return emb.join(graph.graph_clusters(nn, resolutions), "cell_id")


def integrate(gene_sums: DataFrame, cells: DataFrame, hvgs: DataFrame, resolutions: Sequence[float], dbl_resolution: float = 4.0, max_dbl_prop: float = 0.5,
              n_dims: int = 50, theta: float = 0.1) -> DataFrame:
    """Two passes: clusters of cells and doublets mark doublet clusters; clean cells are integrated again.

    ``cells`` has cell_id, batch and is_dbl. Rows of removed cells keep only the first-pass columns.
    """
    first = integrate_once(gene_sums, cells, hvgs, [dbl_resolution], n_dims, 0.0)
    col = f"RNA_snn_res.{dbl_resolution}"
    dbl = labels.doublet_clusters(first.select("cell_id", F.col(f"`{col}`").alias("dbl_cluster")).join(cells.select("cell_id", "is_dbl"), "cell_id"), "dbl_cluster", max_dbl_prop)
    dbl = cut_lineage(dbl.drop("dbl_cl_size"))
    clean = cells.join(dbl.where("keep").select("cell_id"), "cell_id", "left_semi")
    second = integrate_once(gene_sums, clean, hvgs, resolutions, n_dims, theta)
    return second.join(dbl.drop("keep"), "cell_id", "full")


def find_markers(gene_sums: DataFrame, cells: DataFrame, genes: DataFrame, min_cl_size: int = 100, min_cells: int = 10) -> DataFrame:
    return cut_lineage(markers.marker_genes(gene_sums, cells, genes, min_cl_size, min_cells))


def enrich(marker_table: DataFrame, sets: DataFrame, cut: float = 0.05, n_perm: int = 1000) -> DataFrame:
    """Gene-set enrichment per cluster with main pathways marked."""
    ranks = cut_lineage(gsea.gsea_ranks(markers.filter_biotype(marker_table)))
    return gsea.collapse_pathways(cut_lineage(gsea.gsea(ranks, sets, n_perm)), ranks, sets, cut)


def label_cells(gene_sums: DataFrame, model: DataFrame, intercepts: DataFrame, clusters: DataFrame, min_prop: float = 0.5,
                scaling: DataFrame | None = None) -> DataFrame:
    """Cell labels from a linear model and the majority label of each high-resolution cluster.

    Counts are scaled to the median library (of each batch, if ``gene_sums`` has batches). Every cell of the
    counts is classified; ``scaling`` (gene_id, centre, scale) is the model's own.
    """
    by = ["batch"] if "batch" in gene_sums.columns else None
    logs = C.normalise_total(gene_sums, by=by)
    called = labels.classify_cells(logs, model, intercepts, "normcount", gene_sums, scaling)
    return labels.majority_label(called, clusters, min_prop)


@dataclass(frozen=True)
class SubsetResult:
    status: DataFrame
    ambient: DataFrame
    hvgs: DataFrame
    integration: DataFrame
    markers: DataFrame


def analyse_subset(gene_sums: DataFrame, cells: DataFrame, label_col: str, selected: Sequence[str], earlier: DataFrame, pb_empty: DataFrame,
                   genes: DataFrame, resolutions: Sequence[float], marker_resolution: float, min_cells: int = 10, n_hvgs: int = N_HVGS, n_dims: int = 50,
                   min_cl_size: int = 100, pb_min_cells: int = 10) -> SubsetResult:
    """Re-analysis of the cells with the selected labels: status, ambient genes, variable genes, clusters, markers."""
    sub = qc.subset_by_label(cells, label_col, selected)
    status = cut_lineage(labels.subset_sample_stats(sub, cells.select("batch").distinct(), earlier, min_cells))
    checks.gate(checks.enough_good_batches(status), "fewer than two good batches in the subset")
    sub = cut_lineage(qc.drop_bad_batches(sub, status).select("cell_id", "batch"))
    src = cut_lineage(C.sum_splice(gene_sums.join(sub.select("cell_id"), "cell_id", "left_semi")))
    pb = cut_lineage(P.pseudobulk_cells(src, sub).withColumnRenamed("batch", "sample_id"))
    amb = cut_lineage(markers.ambient_genes(pb, pb_empty))
    hv = find_hvgs(src, sub, n_hvgs, exclude=hvg.excluded_genes(amb))
    integ = cut_lineage(integrate_once(src, sub, hv, resolutions, n_dims))
    cl = integ.select("cell_id", "batch", F.col(f"`RNA_snn_res.{marker_resolution}`").alias("cluster"))
    mk = find_markers(src, cl, genes, min_cl_size, pb_min_cells)
    return SubsetResult(status, amb, hv, integ, mk)

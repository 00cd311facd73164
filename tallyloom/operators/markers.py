"""Marker genes: tests of one cluster (or group) against the rest, and tables built on them.

The t test is a closed form over sums of non-zero counts, so all clusters are tested by the same
aggregates: the sums of "the others" are total minus own. Fitted models are in ``nb`` and ``voom``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import signed_log10, significant, stars
from tallyloom.functions.stats import t_two_sided
from tallyloom.operators import joins, ordered
from tallyloom.operators import pseudobulk as P
from tallyloom.operators.nb import nb_ql_test
from tallyloom.operators.voom import voom_test
from tallyloom.session import cut_lineage

def welch_test(means: DataFrame, samples: DataFrame, cluster: str = "cluster") -> DataFrame:
    """t test on mean log CPM of each cluster against all other samples.

    ``means`` comes from ``mean_log_cpm``; genes without counts in a cluster stand at ln 10 there.
    """
    base = F.ln(F.lit(P.PSEUDO_CPM))
    n_all = samples.agg(F.count(F.lit(1)).alias("n")).scalar()
    n, m = F.col("n_samples"), F.col("mean_logcpm")
    square = F.coalesce(F.col("var_logcpm"), F.lit(0.0)) * (n - 1) + n * m * m
    x = means.withColumns({"_sum": n * m, "_sq": square})
    tot = x.groupBy("gene_id").agg(F.sum("_sum").alias("_ts"), F.sum("_sq").alias("_tq"), F.sum("n_samples").alias("_tn"))
    j = x.join(tot, "gene_id").withColumn("_all", n_all)
    absent = F.col("_all") - F.col("_tn")
    k = F.col("_all") - n
    j = j.withColumns({
        "_k": k,
        "_om": (F.col("_ts") - F.col("_sum") + absent * base) / F.when(k > 0, k),
        "_oq": F.col("_tq") - F.col("_sq") + absent * base * base})
    ov = (F.col("_oq") - F.col("_k") * F.col("_om") * F.col("_om")) / F.when(F.col("_k") > 1, F.col("_k") - 1)
    # a side with one sample has no variance, so no test
    a = F.when(n > 1, F.greatest(F.col("var_logcpm"), F.lit(0.0)) / n)
    b = F.when(F.col("_k") > 1, F.greatest(ov, F.lit(0.0)) / F.col("_k"))
    j = j.withColumns({"_a": a, "_b": b})
    se2 = F.col("_a") + F.col("_b")
    den = F.col("_a") * F.col("_a") / F.when(n > 1, n - 1) + F.col("_b") * F.col("_b") / F.when(F.col("_k") > 1, F.col("_k") - 1)
    return j.select(
        cluster, "gene_id", (m - F.col("_om")).alias("diff"),
        F.when(se2 > 1e-12, (m - F.col("_om")) / F.sqrt(F.when(se2 > 1e-12, se2))).alias("t"),
        F.when(den > 1e-24, se2 * se2 / F.when(den > 1e-24, den)).alias("df"))


def with_p_values(tests: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Two-sided p-values and adjusted p-values per cluster."""
    return ordered.bh_adjust(tests.withColumn("PValue", t_two_sided("t", "df")), cluster, "PValue", "FDR", bounded=True)


def group_libraries(pb: DataFrame, sample: Sequence[str]) -> DataFrame:
    """Usable libraries of one group of samples (log-MAD outliers dropped), normalised."""
    keys = list(sample)
    libs = P.mad_outliers(P.sample_libraries(pb, keys), None).where(~F.col("is_outlier")).select(*keys)
    f = P.norm_factors(cut_lineage(pb.join(libs, keys, "left_semi")), keys)
    return f.select(*keys, F.col("norm_lib_size").alias("lib_size"))


def ambient_genes(pb_cells: DataFrame, pb_empty: DataFrame, fdr: float = 0.01, min_logfc: float = 0.0,
                  sample: str = "sample_id") -> DataFrame:
    """Genes enriched in empty droplets over cells: tests, mean log CPM per side, ``is_ambient``."""
    both, libs = [], []
    for name, pb in (("cells", pb_cells), ("empties", pb_empty)):
        x = pb.select(F.lit(name).alias("side"), F.col(sample).cast("string").alias("sample"), "gene_id", "count")
        both.append(x)
        libs.append(group_libraries(x, ["side", "sample"]))
    counts, samples = both[0].unionByName(both[1]), cut_lineage(libs[0].unionByName(libs[1]))
    common = pb_cells.select("gene_id").intersect(pb_empty.select("gene_id"))
    counts = cut_lineage(counts.join(common, "gene_id", "left_semi").where("count > 0"))
    keep = P.filter_by_expression(counts, samples, "side", ["side", "sample"])
    test = nb_ql_test(counts, samples, "side", ["side", "sample"], keep).where("side = 'empties'").drop("side")
    n = samples.groupBy("side").agg(F.count(F.lit(1)).alias("k"))
    lc = counts.join(samples, ["side", "sample"]).withColumn("l", F.ln(F.col("count") / F.col("lib_size") * P.MILLION + 1.0))
    m = lc.groupBy("side", "gene_id").agg(F.sum("l").alias("s")).join(n, "side").withColumn("m", F.col("s") / F.col("k"))
    wide = m.groupBy("gene_id").agg(
        F.coalesce(F.max(F.when(F.col("side") == "cells", F.col("m"))), F.lit(0.0)).alias("mean_logcpm_cells"),
        F.coalesce(F.max(F.when(F.col("side") == "empties", F.col("m"))), F.lit(0.0)).alias("mean_logcpm_empties"))
    return test.join(wide, "gene_id").withColumn(
        "is_ambient", F.coalesce((F.col("logFC") > min_logfc) & (F.col("FDR") < fdr), F.lit(False)))


def by_signed_significance(df: DataFrame) -> DataFrame:
    """Rows ordered by log P times the sign of the change, then by decreasing change."""
    return df.orderBy(signed_log10("PValue", "logFC").asc(), F.col("logFC").desc())


def marker_genes(gene_sums: DataFrame, cells: DataFrame, genes: DataFrame, min_cl_size: int = 100, min_cells: int = 10,
                 lib: str = "tmm", cluster: str = "cluster", batch: str = "batch", method: str = "edger") -> DataFrame:
    """Markers of every cluster: pseudobulk, log CPM, test against the rest, means and zero samples.

    ``method`` is ``edger`` (negative-binomial quasi-likelihood) or ``voom`` (weighted linear model). ``cells`` holds cell_id, cluster and batch of clean cells; tiny clusters are left out.
    """
    keys = [cluster, batch]
    size = cells.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_cl_size)
    ids = cells.join(size.select(cluster), cluster, "left_semi").select("cell_id", *keys)
    src = gene_sums.drop(*[k for k in keys if k in gene_sums.columns]).join(ids, "cell_id")
    n = P.n_cells_by(ids, keys)
    pb = P.pseudobulk(src, n, keys)
    return markers_from_pseudobulk(pb, n, genes, min_cells, lib, cluster, batch, method)


def markers_from_pseudobulk(pb: DataFrame, n_cells: DataFrame, genes: DataFrame, min_cells: int = 10, lib: str = "tmm",
                            cluster: str = "cluster", batch: str = "batch", method: str = "edger") -> DataFrame:
    if method not in ("edger", "voom"):
        raise ValueError("method must be edger or voom")
    keys = [cluster, batch]
    ok = cut_lineage(P.usable_samples(pb, n_cells, keys, min_cells))
    used = cut_lineage(pb.select(*keys, "gene_id", "count").join(ok.select(*keys), keys, "left_semi"))
    lc = used.join(ok, keys).withColumn("logcpm", F.ln(F.col("count") / F.col("lib_size") * P.MILLION + P.PSEUDO_CPM))
    libs = ok
    if lib == "tmm":
        libs = cut_lineage(P.norm_factors(used, keys).select(*keys, F.col("norm_lib_size").alias("lib_size")))
    keep = P.filter_by_expression(used, libs, cluster, keys)
    test = nb_ql_test(used, libs, cluster, keys, keep) if method == "edger" else voom_test(used, libs, cluster, keys, keep).drop("t")
    means = P.selected_vs_other(P.mean_log_cpm(lc, ok, cluster), ok, cluster)
    zeros = P.zero_counts(lc, ok, cluster)
    rows = genes.select("gene_id", "symbol", "gene_type")
    return test.join(zeros, [cluster, "gene_id"]).join(means, [cluster, "gene_id"]).join(rows, "gene_id")


def top_markers(markers: DataFrame, fdr_cut: float = 0.01, n: int = 10, max_zero: float = 0.5, cluster: str = "cluster") -> DataFrame:
    """First n genes per cluster: significant and up with few zero samples, then significant and down, then the rest."""
    zero = F.col("n_zero") / F.col("n_cl")
    sig, few = F.col("FDR") < fdr_cut, zero <= max_zero
    tier = (
        F.when(sig & (F.col("logFC") > 0) & few, 1).when(sig & (F.col("logFC") < 0), 2)
        .when((F.col("FDR") >= fdr_cut) & (few | (F.col("logFC") < 0)), 3)
    )
    x = markers.withColumns({"tier": tier, "prop_zero": zero}).where(F.col("tier").isNotNull())
    return joins.first_per_group(x, cluster, [F.col("tier").asc(), F.abs("logFC").desc(), F.col("gene_id").asc()], n)


# Fixed value: gene types that are not shown among markers.
NOT_OK_TYPES = "(lincRNA|lncRNA|pseudogene)"


def filter_biotype(markers: DataFrame, not_ok: str = NOT_OK_TYPES, min_logcpm: float | None = None,
                   max_zero: float | None = None) -> DataFrame:
    """Drop unwanted gene types, low expression, and genes up but absent in many samples."""
    out = markers.where(~F.col("gene_type").rlike(not_ok))
    if min_logcpm is not None:
        out = out.where(F.col("logcpm_sel") >= min_logcpm)
    if max_zero is not None:
        out = out.where((F.col("n_zero") / F.col("n_cl") <= max_zero) | (F.col("logFC") < 0))
    return out


def show_markers(markers: DataFrame, max_fdr: float = 0.01, min_cpm: float = 50, n: int = 10, order_by: str = "pval",
                 cluster: str = "cluster") -> DataFrame:
    """Readable table of the top increased genes per cluster."""
    x = filter_biotype(markers).where(
        (F.col("FDR") < max_fdr) & (F.col("logFC") > 0) & (F.col("logcpm_sel") > F.ln(F.lit(float(min_cpm + 1)))))
    order: list[Column] = [F.col("PValue").asc()] if order_by == "pval" else []
    x = joins.first_per_group(x, cluster, [*order, F.col("logFC").desc(), F.col("gene_id").asc()], n)
    return x.select(cluster, "symbol", *_readable())


def _readable() -> list[Column]:
    return [F.round(significant(F.exp("logcpm_sel") - 1.0, 2)).alias("CPM"), F.round("logFC", 1).alias("log2fc"),
            significant("FDR", 2).alias("FDR")]


def selected_genes(markers: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows of the given (symbol, ord) in the caller's order, then by signed significance."""
    return (
        markers.join(symbols, "symbol")
        .orderBy(F.col("ord"), signed_log10("PValue", "logFC").asc(), F.col("cluster"))
        .select("ord", "symbol", "gene_type", "cluster", *_readable())
    )


def top_labels_to_annotate(tests: DataFrame, n: int = 10, min_empty: float | None = None) -> DataFrame:
    """Genes with the largest change and genes with the smallest P, without doubles."""
    up = tests.where(F.col("logFC") > 0)
    if min_empty:
        up = up.where(F.col("mean_logcpm_empties") > F.ln(F.lit(min_empty + 1.0)))
    a = up.orderBy(F.col("logFC").desc(), "gene_id").limit(n)
    b = up.orderBy(F.col("PValue").asc(), "gene_id").limit(n)
    return a.union(b).distinct()


def fdr_boundary(tests: DataFrame, cut: float = 0.01) -> DataFrame:
    """Largest P inside and smallest P outside the FDR cut, and their mean."""
    x = tests.agg(F.max(F.when(F.col("FDR") <= cut, F.col("PValue"))).alias("p_in"),
                  F.min(F.when(F.col("FDR") > cut, F.col("PValue"))).alias("p_out"))
    return x.withColumn("p_line", (F.col("p_in") + F.col("p_out")) / 2.0)


def heatmap_table(markers: DataFrame, panel: DataFrame, min_cpm: float = 10, pseudo: float = 10, cluster: str = "cluster") -> DataFrame:
    """Panel genes expressed somewhere, with fold change and significance stars per cluster."""
    x = markers.join(panel.select("gene_id"), "gene_id", "left_semi")
    top = x.groupBy("symbol").agg(F.max("logcpm_sel").alias("_m")).where(F.col("_m") >= F.ln(F.lit(float(min_cpm + pseudo))))
    low = (F.col("logcpm_sel") < F.ln(F.lit(float(min_cpm + 1)))) | (F.col("FDR") > 0.05) | (F.col("logFC") < 0)
    return x.join(top, "symbol", "left_semi").select(
        "gene_id", "symbol", cluster, F.col("logFC").alias("log2fc"), F.when(low, "").otherwise(stars("FDR")).alias("signif"))


def marker_panel(custom: DataFrame, hvgs: DataFrame, ambient: DataFrame, n: int = 50) -> DataFrame:
    """Custom, most variable and most ambient genes in one table with the set they come from."""
    hv = hvgs.where("highly_variable").orderBy(F.col("variances_norm").desc(), "gene_id").limit(n)
    am = ambient.where("is_ambient").orderBy(F.col("logFC").desc(), "gene_id").limit(n)
    return (
        custom.select(F.col("label").alias("geneset"), "gene_id")
        .unionByName(hv.select(F.lit("hvgs").alias("geneset"), "gene_id"))
        .unionByName(am.select(F.lit("ambient").alias("geneset"), "gene_id"))
    )


def gene_panel_expression(logcpm: DataFrame, genes: DataFrame, note: str, selected: str, cluster: str = "cluster",
                          batch: str = "batch") -> DataFrame:
    """log CPM per cluster and sample for chosen genes, labelled with a value and the selected cluster marked."""
    x = logcpm.join(genes.select("gene_id", "symbol", note), "gene_id")
    label = F.format_string("%s (%.2e)", F.col("symbol"), F.col(note).cast("double"))
    return x.select(cluster, batch, "gene_id", "logcpm", label.alias("label"), (F.col(cluster) == selected).alias("is_selected"))


def smoothed_order(dots: DataFrame, cluster: str = "cluster", position: str = "position", value: str = "log10cpm",
                   bandwidth: float = 0.5) -> DataFrame:
    """Per cluster the marker position with the highest kernel-smoothed value, first when equal.

    One row per cluster and panel gene; neighbours are joined by position within four bandwidths' reach.
    """
    sd = 0.3706506 * bandwidth
    reach = max(1, int(4 * sd + 1))
    src = dots.select(cluster, F.col(position).alias("_p"), F.col(value).alias("_v"))
    near = src.withColumn("_q", F.explode(F.sequence(F.col("_p") - reach, F.col("_p") + reach)))
    w = F.exp(-0.5 * F.pow((F.col("_q") - F.col("_p")) / sd, 2.0))
    smooth = near.groupBy(cluster, "_q").agg((F.sum(w * F.col("_v")) / F.sum(w)).alias("score"))
    here = smooth.join(src.select(cluster, F.col("_p").alias("_q")), [cluster, "_q"], "left_semi")
    best = here.groupBy(cluster).agg(
        F.max_by(F.struct("_q", "score"), F.struct(F.round("score", 9), -F.col("_q"))).alias("_b"))
    return best.select(cluster, F.col("_b._q").alias(position), F.col("_b.score").alias("smooth_score"))

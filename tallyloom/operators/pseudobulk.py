"""Pseudobulk tables: counts summed over the cells of a sample, per cluster and gene.

Absent (cluster, sample, gene) rows are zeros. Means, variances and zero counts take the
number of samples from the sample table, so the dense table is built only on request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import safe_ratio, symbol_of
from tallyloom.operators import hvg, joins
from tallyloom.operators.ordered import as_list

# Counts per million added before the log, and the million.
PSEUDO_CPM = 10.0
MILLION = 1e6


def n_cells_by(cells: DataFrame, by: Sequence[str] = ("cluster", "batch"), complete: bool = False) -> DataFrame:
    """Cells per combination; ``complete`` adds the empty combinations."""
    n = cells.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cells"))
    return joins.complete(n, list(by[:-1]), [by[-1]], {"n_cells": 0}) if complete else n


def pseudobulk(gene_sums: DataFrame, n_cells: DataFrame, by: Sequence[str] = ("cluster", "batch")) -> DataFrame:
    """Sum, mean, detected cells and detected share per (by, gene) over all cells of the group.

    ``gene_sums`` holds one row per cell and gene.
    """
    keys = list(by)
    pb = gene_sums.groupBy(*keys, "gene_id").agg(
        F.sum("count").alias("count"), F.count_if(F.col("count") > 0).alias("n_detected"))
    return pb.join(n_cells, keys).withColumns({
        "mean": F.col("count") / F.col("n_cells"), "prop_detected": F.col("n_detected") / F.col("n_cells")})


def pseudobulk_median(gene_sums: DataFrame, n_cells: DataFrame, by: Sequence[str] = ("cluster", "batch")) -> DataFrame:
    """Median count per (by, gene) over all cells of the group, zeros included."""
    return hvg.quantiles_with_zeros(gene_sums, n_cells, {"median": 0.5}, by)


def complete_pseudobulk(pb: DataFrame, by: Sequence[str] = ("cluster", "batch"), fill: Sequence[str] = ("count",)) -> DataFrame:
    """Zero-filled gene x (cluster, sample) table."""
    return joins.complete(pb, ["gene_id"], list(by), {c: 0 for c in fill})


def pseudobulk_empties(counts: DataFrame, ranks: DataFrame, run: str = "run_id") -> DataFrame:
    """Gene sums over the empty plateau of each run."""
    empties = ranks.where("in_empty_plateau").select(run, "barcode")
    return counts.join(empties, [run, "barcode"], "left_semi").groupBy(run, "gene_id").agg(F.sum("count").alias("count"))


def pseudobulk_cells(counts: DataFrame, cells: DataFrame, status: DataFrame | None = None, batch: str = "batch") -> DataFrame:
    """Gene sums over the given cells of the batches that passed."""
    ids = cells.select("cell_id", batch)
    if status is not None:
        ids = ids.join(status.where(~F.col(f"bad_{batch}")).select(batch), batch, "left_semi")
    src = counts.drop(batch) if batch in counts.columns else counts
    return src.join(ids, "cell_id").groupBy(batch, "gene_id").agg(F.sum("count").alias("count"))


def sample_libraries(pb: DataFrame, by: Sequence[str] = ("cluster", "batch")) -> DataFrame:
    """Library size of each pseudobulk sample; samples without counts drop out."""
    return pb.groupBy(*by).agg(F.sum("count").alias("lib_size")).where("lib_size > 0")


def mad_outliers(libs: DataFrame, by="cluster", value: str = "lib_size", nmads: float = 3.0) -> DataFrame:
    """Flag samples whose log library lies below the median by more than ``nmads`` scaled MADs.

    One row per pseudobulk sample, so a group is bounded by the number of samples.
    """
    keys = as_list(by)
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    x = libs.withColumn("_l", F.ln(F.col(value))).withColumn("_m", F.median("_l").over(w))
    x = x.withColumn("_mad", F.median(F.abs(F.col("_l") - F.col("_m"))).over(w) * 1.4826)
    return x.withColumn("is_outlier", F.col("_l") < F.col("_m") - nmads * F.col("_mad")).drop("_l", "_m", "_mad")


def usable_samples(pb: DataFrame, n_cells: DataFrame, by: Sequence[str] = ("cluster", "batch"), min_cells: int = 10) -> DataFrame:
    """Samples with enough cells and an inlying library: (by, lib_size, n_cells)."""
    keys = list(by)
    libs = sample_libraries(pb, keys).join(n_cells.where(F.col("n_cells") >= min_cells), keys)
    return mad_outliers(libs, keys[:-1]).where(~F.col("is_outlier")).drop("is_outlier")


def norm_factors(pb: DataFrame, sample: Sequence[str], logratio_trim: float = 0.3, sum_trim: float = 0.05) -> DataFrame:
    """Trimmed-mean-of-M-values factors against the sample whose upper quartile is closest to the mean.

    Ranks run within one sample over its genes (bounded by the annotation).
    """
    keys = list(sample)
    tag = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])
    x = pb.where("count > 0").withColumn("_s", tag).select("_s", *keys, "gene_id", F.col("count").cast("double").alias("y"))
    genes = x.select("gene_id").distinct().agg(F.count(F.lit(1)).alias("k")).scalar()
    lib = x.groupBy("_s", *keys).agg(F.sum("y").alias("lib"))
    # upper quartile of count / library over all expressed genes, zeros included
    w = Window.partitionBy("_s").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
    z = genes - F.count(F.lit(1)).over(Window.partitionBy("_s"))
    pos = x.withColumns({"_c": F.row_number().over(Window.partitionBy("_s").orderBy("y", "gene_id")), "_z": z, "_g": genes})
    at = (F.col("_g") - 1) * 0.75
    lo = F.floor(at)
    q = pos.groupBy("_s", "_z", "_g").agg(
        F.min(F.when(F.col("_c") + F.col("_z") > lo, F.col("y"))).alias("a"),
        F.min(F.when(F.col("_c") + F.col("_z") > F.least(lo + 1, F.col("_g") - 1), F.col("y"))).alias("b"))
    a = F.when(lo < F.col("_z"), 0.0).otherwise(F.col("a"))
    b = F.when(F.least(lo + 1, F.col("_g") - 1) < F.col("_z"), 0.0).otherwise(F.col("b"))
    q = q.select("_s", (a + (b - a) * (at - lo)).alias("uq")).join(lib, "_s").withColumn("f75", F.col("uq") / F.col("lib"))
    mean75 = q.agg(F.avg("f75").alias("m")).scalar()
    ref = q.agg(F.min_by("_s", F.struct(F.round(F.abs(F.col("f75") - mean75), 12), F.col("_s"))).alias("s")).scalar()
    r = x.where(F.col("_s") == ref).join(lib.select("_s", "lib"), "_s").select(
        "gene_id", F.col("y").alias("yr"), F.col("lib").alias("lr"))
    j = x.join(lib.select("_s", "lib"), "_s").join(r, "gene_id")
    po, pr = F.col("y") / F.col("lib"), F.col("yr") / F.col("lr")
    j = j.withColumns({
        "m": F.round(F.log2(po / pr), 10), "e": F.round((F.log2(po) + F.log2(pr)) / 2.0, 10),
        "v": (F.col("lib") - F.col("y")) / F.col("lib") / F.col("y") + (F.col("lr") - F.col("yr")) / F.col("lr") / F.col("yr")})
    by_s = Window.partitionBy("_s")

    def mid(c: str) -> Column:
        ties = F.count(F.lit(1)).over(Window.partitionBy("_s", c))
        return F.rank().over(by_s.orderBy(c)) + (ties - 1) / F.lit(2.0)

    j = j.withColumns({"n": F.count(F.lit(1)).over(by_s), "rm": mid("m"), "re": mid("e")})
    cut_m, cut_e = F.floor(F.col("n") * logratio_trim) + 1, F.floor(F.col("n") * sum_trim) + 1
    kept = j.where(F.col("rm").between(cut_m, F.col("n") + 1 - cut_m) & F.col("re").between(cut_e, F.col("n") + 1 - cut_e))
    f = kept.where("v > 0").groupBy("_s").agg((F.sum(F.col("m") / F.col("v")) / F.sum(1.0 / F.col("v"))).alias("lf"))
    out = lib.join(f, "_s", "left").withColumn("lf", F.coalesce("lf", F.lit(0.0)))
    centre = out.agg(F.avg("lf").alias("c")).scalar()
    return out.select(*keys, F.col("lib").alias("lib_size"), F.pow(F.lit(2.0), F.col("lf") - centre).alias("norm_factor")).withColumn(
        "norm_lib_size", F.col("lib_size") * F.col("norm_factor"))


def log_cpm(pb: DataFrame, n_cells: DataFrame, by: Sequence[str] = ("cluster", "batch"), min_cells: int = 10,
            lib: str = "raw", zeros: bool = False, exclude_regex: str | None = None) -> DataFrame:
    """ln(count / library * 1e6 + 10) for usable samples; ``lib='tmm'`` uses normalised libraries.

    Rows for zero counts (all equal to ln 10) are written only with ``zeros=True``.
    """
    keys = list(by)
    src = pb.select(*keys, "gene_id", "count")
    if exclude_regex is not None:
        src = src.where(~F.col("gene_id").rlike(exclude_regex))
    ok = usable_samples(src, n_cells, keys, min_cells)
    if lib == "tmm":
        # factors are taken within each cluster's own samples by scaling all samples jointly
        f = norm_factors(src.join(ok.select(*keys), keys, "left_semi"), keys)
        ok = ok.drop("lib_size").join(f.select(*keys, F.col("norm_lib_size").alias("lib_size")), keys)
    if zeros:
        src = complete_pseudobulk(src.join(ok.select(*keys), keys, "left_semi"), keys)
    return src.join(ok, keys).withColumn(
        "logcpm", F.ln(F.col("count") / F.col("lib_size") * MILLION + PSEUDO_CPM))


def with_symbol(df: DataFrame) -> DataFrame:
    return df.withColumn("symbol", symbol_of(F.col("gene_id").cast("string")))


def detection_props(pb: DataFrame, by: Sequence[str] = ("cluster", "batch"), min_cells: int = 10) -> DataFrame:
    """Detected share per cluster, sample and gene, samples with few cells dropped."""
    return pb.where(F.col("n_cells") >= min_cells).select(*by, "gene_id", F.col("prop_detected").alias("prop"), "n_cells")


def mean_log_cpm(logcpm: DataFrame, samples: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean log CPM per cluster and gene over all usable samples; zero samples enter as ln 10."""
    n = samples.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_samples"))
    s = logcpm.where("count > 0").groupBy(cluster, "gene_id").agg(
        F.sum("logcpm").alias("_s"), F.sum(F.col("logcpm") * F.col("logcpm")).alias("_q"), F.count(F.lit(1)).alias("n_nonzero"))
    base = F.ln(F.lit(PSEUDO_CPM))
    gap = F.col("n_samples") - F.col("n_nonzero")
    total, square = F.col("_s") + gap * base, F.col("_q") + gap * base * base
    mean = total / F.col("n_samples")
    return s.join(n, cluster).select(
        cluster, "gene_id", "n_samples", "n_nonzero", mean.alias("mean_logcpm"),
        F.when(F.col("n_samples") > 1, (square - F.col("n_samples") * mean * mean) / F.when(
            F.col("n_samples") > 1, F.col("n_samples") - 1)).alias("var_logcpm"))


def selected_vs_other(means: DataFrame, samples: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Mean log CPM in a cluster and, weighted by samples, in all other clusters.

    One total per gene replaces a loop over clusters: others = total - own. A gene without any
    count in a cluster has the mean ln 10 there, which the totals account for.
    """
    base = F.ln(F.lit(PSEUDO_CPM))
    n_all = samples.agg(F.count(F.lit(1)).alias("n")).scalar()
    tot = means.groupBy("gene_id").agg(
        F.sum(F.col("n_samples") * F.col("mean_logcpm")).alias("_wx"), F.sum("n_samples").alias("_w"))
    j = means.join(tot, "gene_id").withColumn("_n_all", n_all)
    all_sum = F.col("_wx") + (F.col("_n_all") - F.col("_w")) * base
    rest = F.col("_n_all") - F.col("n_samples")
    return j.select(
        cluster, "gene_id", F.col("mean_logcpm").alias("logcpm_sel"),
        F.when(rest > 0, (all_sum - F.col("n_samples") * F.col("mean_logcpm")) / F.when(rest > 0, rest)).alias("logcpm_other"))


def zero_counts(logcpm: DataFrame, samples: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Samples without a count, and samples, per cluster and gene."""
    n = samples.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_cl"))
    nz = logcpm.where("count > 0").groupBy(cluster, "gene_id").agg(F.count(F.lit(1)).alias("_k"))
    return nz.join(n, cluster).select(cluster, "gene_id", (F.col("n_cl") - F.col("_k")).alias("n_zero"), "n_cl")


def filter_by_expression(pb: DataFrame, samples: DataFrame, group: str = "cluster", sample: Sequence[str] = ("cluster", "batch"),
                         min_count: float = 1, min_total: float = 15) -> DataFrame:
    """Genes expressed in about as many samples as the smallest group has, and with enough counts."""
    keys = list(sample)
    sizes = samples.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("m"))
    need = sizes.select(F.when(F.col("m") > 10, 10 + (F.col("m") - 10) * 0.7).otherwise(F.col("m").cast("double")).alias("m")).scalar()
    cutoff = samples.agg((F.lit(float(min_count)) / F.median("lib_size") * MILLION).alias("c")).scalar()
    x = pb.select(*keys, "gene_id", "count").join(samples.select(*keys, "lib_size"), keys).withColumn("_cut", cutoff)
    hits = F.count_if(F.col("count") / F.col("lib_size") * MILLION >= F.col("_cut"))
    g = x.groupBy("gene_id").agg(hits.alias("n_ok"), F.sum("count").alias("total"))
    return g.where((F.col("n_ok") >= need - 1e-14) & (F.col("total") >= min_total - 1e-14)).select("gene_id")


def stabilised_variance(pb: DataFrame, samples: DataFrame, sample: Sequence[str] = ("cluster", "batch")) -> DataFrame:
    """Variance per gene of a variance-stabilised transform, asinh(sqrt(a x)) / sqrt(a) on size-factor scale.

    ``a`` is the mean over genes of the moment estimate (var - mean) / mean^2. Zero counts map to
    zero and are accounted for by the number of samples.
    """
    keys = list(sample)
    mean_lib = samples.agg(F.avg("lib_size").alias("l")).scalar()
    n = samples.agg(F.count(F.lit(1)).alias("n")).scalar()
    x = pb.select(*keys, "gene_id", "count").join(samples.select(*keys, "lib_size"), keys).withColumns({
        "_ml": mean_lib, "_n": n}).withColumn("x", F.col("count") / F.col("lib_size") * F.col("_ml"))
    m = x.groupBy("gene_id", "_n").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    mean = F.col("s") / F.col("_n")
    var = (F.col("q") - F.col("_n") * mean * mean) / F.when(F.col("_n") > 1, F.col("_n") - 1)
    a = m.agg(F.greatest(F.avg(F.greatest((var - mean) / (mean * mean), F.lit(0.0))), F.lit(1e-8)).alias("a")).scalar()
    t = x.withColumn("_a", a).withColumn("t", F.asinh(F.sqrt(F.col("_a") * F.col("x"))) / F.sqrt("_a"))
    g = t.groupBy("gene_id", "_n").agg(F.sum("t").alias("s"), F.sum(F.col("t") * F.col("t")).alias("q"))
    mean_t = F.col("s") / F.col("_n")
    return g.select("gene_id", mean_t.alias("vst_mean"), ((F.col("q") - F.col("_n") * mean_t * mean_t) / F.when(
        F.col("_n") > 1, F.col("_n") - 1)).alias("vst_var"))


def top_genes(df: DataFrame, by: str, n: int = 30, where: Column | None = None, ascending: bool = False) -> DataFrame:
    """First n genes by a criterion; ties by gene_id."""
    src = df if where is None else df.where(where)
    return src.orderBy(F.col(by).asc() if ascending else F.col(by).desc(), F.col("gene_id").asc()).limit(n)


def dotplot_stats(pb: DataFrame, samples: DataFrame, by: Sequence[str] = ("cluster", "batch"), pseudo: float = 1.0) -> DataFrame:
    """CPM, log10 CPM and detected share per cluster and gene over all samples of the cluster."""
    keys = list(by)
    size = samples.groupBy(keys[0]).agg(F.sum("lib_size").alias("lib_size"), F.sum("n_cells").alias("n_cells"))
    g = pb.join(samples.select(*keys), keys, "left_semi").groupBy(keys[0], "gene_id").agg(
        F.sum("count").alias("count"), F.sum("n_detected").alias("n_detected"))
    cpm = safe_ratio(F.col("count"), F.col("lib_size")) * MILLION
    return g.join(size, keys[0]).select(
        keys[0], "gene_id", cpm.alias("cpm"), F.log10(cpm + pseudo).alias("log10cpm"),
        safe_ratio(F.col("n_detected"), F.col("n_cells")).alias("p_detect"))

"""Per-cell quality metrics, thresholds, filters and per-batch status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import above, below, inside, log10_or_neg_inf, logit, right_closed_bin, share_logit
from tallyloom.functions.scalars import INF
from tallyloom.operators import ordered
from tallyloom.operators.counts import MT_RRNA_TYPE, RRNA_TYPE

# The loosest limits that thresholds may set.
HARD_LIMITS = {"min_counts": 200, "min_feats": 100, "max_mito": 0.5}

CUT_COLUMNS = ("min_counts", "min_feats", "min_mito", "max_mito", "min_splice", "max_splice", "min_cells")

# Borders of the categories for batch size, counts, features and shares.
SIZE_BREAKS = (1, 100, 200, 400, 1000, 2000, 4000, 10000, 20000, 40000, INF)
COUNT_BREAKS = (1, 100, 300, 1000, 3000, 10000, 30000, INF)
SHARE_BREAKS = (0, 0.01, 0.05, 0.1, 0.2, 0.5, 1)


def cell_qc_metrics(counts: DataFrame, genes: DataFrame, cell: Sequence[str] = ("cell_id",),
                    rrna: str = RRNA_TYPE, mt_rrna: str = MT_RRNA_TYPE) -> DataFrame:
    """Quality metrics per cell from counts(cell, gene_id, splice, count) and genes(gene_id, gene_type, is_mito).

    Counts are first folded to one row per cell and gene, so ``detected`` sees the splice sum
    and a hot cell is spread over its genes. Spliced and unspliced sums include rRNA genes.
    """
    keys = list(cell)
    tag, n = F.col("splice"), F.col("count")
    per_gene = counts.groupBy(*keys, "gene_id").agg(
        F.sum(n).alias("n"),
        F.sum(F.when(tag == "S", n).otherwise(0.0)).alias("s"),
        F.sum(F.when(tag == "U", n).otherwise(0.0)).alias("u"),
    )
    x = per_gene.join(genes.select("gene_id", "gene_type", "is_mito"), "gene_id")
    is_r, is_mr = F.col("gene_type") == rrna, F.col("gene_type") == mt_rrna
    kept = ~(is_r | is_mr)
    mito = kept & F.col("is_mito")

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0.0))

    out = x.groupBy(*keys).agg(
        total(kept).alias("sum"),
        F.count_if(kept & (F.col("n") > 0)).alias("detected"),
        total(mito).alias("subsets_mito_sum"),
        F.count_if(mito & (F.col("n") > 0)).alias("subsets_mito_detected"),
        F.sum("s").alias("total_spliced"),
        F.sum("u").alias("total_unspliced"),
        F.sum("n").alias("total_w_ribo"),
        total(is_r).alias("total_rrna"),
        total(is_mr).alias("total_mt_rrna"),
    )
    return out.where(F.col("sum") > 0).withColumns({
        "total": F.col("sum"),
        "subsets_mito_percent": F.col("subsets_mito_sum") / F.col("sum") * 100.0,
        "logit_spliced": share_logit(F.col("total_spliced"), F.col("total_spliced") + F.col("total_unspliced")),
    })


def _first_present(df: DataFrame, options: Mapping[tuple[str, ...], Column], what: str) -> Column:
    for needed, expr in options.items():
        if set(needed) <= set(df.columns):
            return expr
    raise ValueError(f"no column to derive {what} from; need one of {list(options)}")


def qc_metrics(cells: DataFrame) -> DataFrame:
    """log_counts, log_feats, logit_mito, logit_spliced and splice_ratio, from the first usable columns."""
    pos = lambda c: F.log10(F.when(F.col(c) > 0, F.col(c)))
    mito_from_pct = F.col("nCount_RNA") * F.col("percent_mt") / 100.0 if "percent_mt" in cells.columns else F.lit(0.0)
    specs = {
        "log_counts": {("log_counts",): F.col("log_counts"), ("sum",): pos("sum"), ("total",): pos("total"),
                       ("nCount_RNA",): pos("nCount_RNA")},
        "log_feats": {("log_feats",): F.col("log_feats"), ("detected",): pos("detected"),
                      ("nFeature_RNA",): pos("nFeature_RNA")},
        "logit_mito": {("logit_mito",): F.col("logit_mito"),
                       ("subsets_mito_sum", "total"): share_logit("subsets_mito_sum", "total"),
                       ("subsets_mt_sum", "total"): share_logit("subsets_mt_sum", "total"),
                       ("percent_mt", "nCount_RNA"): share_logit(mito_from_pct, "nCount_RNA"),
                       ("mito_prop", "log_counts"): share_logit(
                           F.col("mito_prop") * F.pow(F.lit(10.0), F.col("log_counts")),
                           F.pow(F.lit(10.0), F.col("log_counts")))},
        "logit_spliced": {("logit_spliced",): F.col("logit_spliced"),
                          ("total_spliced", "total_unspliced"): share_logit(
                              "total_spliced", F.col("total_spliced") + F.col("total_unspliced"))},
        "splice_ratio": {("splice_ratio",): F.col("splice_ratio"),
                         ("total_spliced", "total_unspliced"): F.log2(
                             (F.col("total_spliced") + 1.0) / (F.col("total_unspliced") + 1.0))},
    }
    return cells.withColumns({name: _first_present(cells, opts, name) for name, opts in specs.items()})


def thresholds(batches: DataFrame, defaults: Mapping[str, float], custom: DataFrame | None = None,
               batch: str = "batch") -> DataFrame:
    """Seven limits per batch: the custom value where one is given, else the default."""
    out = batches.select(batch).distinct()
    if custom is not None:
        out = out.join(custom, batch, "left")
    given = set(custom.columns) if custom is not None else set()
    cols = []
    for c in CUT_COLUMNS:
        kind = "long" if c in ("min_counts", "min_feats", "min_cells") else "double"
        default = F.lit(defaults[c]).cast(kind)
        cols.append((F.coalesce(F.col(c).cast(kind), default) if c in given else default).alias(c))
    return out.select(batch, *cols)


def hard_limits(defaults: Mapping[str, float]) -> dict[str, float]:
    """Limits of the first filter stage: never stricter than the fixed values."""
    return {
        "min_counts": min(HARD_LIMITS["min_counts"], defaults["min_counts"]),
        "min_feats": min(HARD_LIMITS["min_feats"], defaults["min_feats"]),
        "max_mito": max(HARD_LIMITS["max_mito"], defaults["max_mito"]),
    }


def singlet_predicate(demux: str, batch_is_sample: bool) -> Column:
    """Which doublet and tag flags a cell must pass to be counted as one cell."""
    one = F.col("scdbl_class") == "singlet"
    if demux == "none" or not batch_is_sample:
        return one
    tagged = one & (F.col("demux_class") == "singlet")
    return tagged & F.col("valid_hto") if demux == "hto" else tagged


def doublet_predicate(demux: str, batch_is_sample: bool) -> Column:
    two = F.col("scdbl_class") == "doublet"
    return two if demux == "none" or not batch_is_sample else two | (F.col("demux_class") == "doublet")


def filter_qc(cells: DataFrame, cuts: DataFrame, hard: Mapping[str, float], batch: str = "batch",
              eligible: Column | None = None) -> DataFrame:
    """Add ``keep_hard`` and ``keep``: hard limits first, then the limits of the cell's batch."""
    m = cells.join(cuts.drop("min_cells"), batch)
    ok = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    counts, feats, mito, spliced = (F.col(c) for c in ("log_counts", "log_feats", "logit_mito", "logit_spliced"))
    hard_ok = (
        ok & (counts >= log10_or_neg_inf(F.lit(float(hard["min_counts"]))))
        & (feats >= log10_or_neg_inf(F.lit(float(hard["min_feats"]))))
        & (mito < logit(F.lit(float(hard["max_mito"]))))
    )
    batch_ok = (
        (counts >= log10_or_neg_inf("min_counts")) & (feats >= log10_or_neg_inf("min_feats"))
        & (mito > logit("min_mito")) & (mito < logit("max_mito"))
        & (spliced > logit("min_splice")) & (spliced < logit("max_splice"))
    )
    return m.withColumns({
        "keep_hard": F.coalesce(hard_ok, F.lit(False)),
        "keep": F.coalesce(hard_ok & batch_ok, F.lit(False)),
    }).select(*cells.columns, "keep_hard", "keep")


def sample_qc_stats(cells: DataFrame, cuts: DataFrame, batch: str = "batch",
                    failed_batches: DataFrame | None = None) -> DataFrame:
    """Kept cells per batch and pass/fail; batches that failed ambient removal fail too."""
    kept = cells.where("keep").groupBy(batch).agg(F.count(F.lit(1)).alias("n_cells"))
    out = (
        cuts.select(batch, "min_cells").join(kept, batch, "left").fillna({"n_cells": 0})
        .withColumn("bad_qc", F.col("n_cells") < F.col("min_cells"))
    )
    bad = F.col("bad_qc")
    if failed_batches is not None:
        extra = failed_batches.select(batch).distinct().select(
            batch, F.lit(None).cast("long").alias("min_cells"), F.lit(None).cast("long").alias("n_cells"),
            F.lit(False).alias("bad_qc"), F.lit(True).alias("bad_bender"))
        out = out.withColumn("bad_bender", F.lit(False)).unionByName(extra)
        bad = bad | F.col("bad_bender")
    return out.withColumn(f"bad_{batch}", bad)


def ambient_run_stats(kept: DataFrame, ranks: DataFrame, custom: DataFrame | None = None, run: str = "run_id",
                      max_prop_kept: float = 0.9) -> DataFrame:
    """Kept barcodes over droplets included per run; too large a share marks a bad run."""
    n_kept = kept.groupBy(run).agg(F.count(F.lit(1)).alias("kept_droplets"))
    total = ranks.groupBy(run).agg(F.max("total_droplets_included").alias("total_droplets"))
    out = n_kept.join(total, run)
    if custom is not None:
        out = out.join(custom.select(run, F.col("total_droplets_included").alias("_own")), run, "left").withColumn(
            "total_droplets", F.coalesce("_own", "total_droplets")).drop("_own")
    return out.withColumn("prop_kept", F.col("kept_droplets") / F.col("total_droplets")).withColumn(
        "bad_run", F.col("prop_kept") > max_prop_kept)


def ambient_exclusions(stats: DataFrame, run: str = "run_id") -> DataFrame:
    return stats.select(run, "total_droplets", "kept_droplets",
                        F.round(F.col("prop_kept") * 100.0, 1).alias("pct_kept"), "bad_run")


def drop_bad_batches(df: DataFrame, status: DataFrame, batch: str = "batch") -> DataFrame:
    return df.join(status.where(~F.col(f"bad_{batch}")).select(batch), batch, "left_semi")


def subset_by_label(df: DataFrame, col: str, values: Sequence[str] | None = None) -> DataFrame:
    """Rows where a boolean column is true, or where the value as text is among ``values``."""
    if values is None:
        return df.where(F.col(col))
    return df.where(F.col(col).cast("string").isin(*values))


def cuts_long(cuts: DataFrame, batch: str = "batch") -> DataFrame:
    """Limits as (batch, qc_var, min, max) on the log10 / logit scale; missing ends are infinite."""
    log, lgt = log10_or_neg_inf, logit
    lo, hi = F.lit(-INF), F.lit(INF)
    rows = [("log_counts", log("min_counts"), hi), ("log_feats", log("min_feats"), hi),
            ("logit_mito", lgt("min_mito"), lgt("max_mito")),
            ("logit_spliced", lgt("min_splice"), lgt("max_splice")),
            ("n_cells", log("min_cells"), hi)]
    structs = [F.struct(F.lit(v).alias("qc_var"), F.coalesce(a, lo).alias("min"), F.coalesce(b, hi).alias("max"))
               for v, a, b in rows]
    return cuts.select(batch, F.inline(F.array(*structs)))


def metrics_long(cells: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Long form of the metric columns that are present."""
    here = [c for c in names if c in cells.columns]
    return cells.select(*ids, *[F.col(c).cast("double") for c in here]).unpivot(list(ids), here, "qc_var", "qc_val")


def quantile_summary(cells: DataFrame, names: Sequence[str], batch: str = "batch") -> DataFrame:
    """log10 N, median, 10/90 and 2.5/97.5 percentiles per batch and metric."""
    long = metrics_long(cells, [batch], names)
    q = ordered.quantiles(long, [batch, "qc_var"], "qc_val",
                          {"q50": 0.5, "q10": 0.1, "q90": 0.9, "q025": 0.025, "q975": 0.975})
    n = long.groupBy(batch, "qc_var").agg(F.log10(F.count(F.lit(1))).alias("log10_n"))
    return q.join(n, [batch, "qc_var"])


def annotate_batches(cells: DataFrame, batch: str = "batch") -> DataFrame:
    """Batch size, medians and their categories on every cell (aggregate and join back, no window)."""
    n = cells.groupBy(batch).agg(F.log10(F.count(F.lit(1))).alias("log_n"))
    long = cells.select(
        batch, F.inline(F.array(
            F.struct(F.lit("c").alias("k"), F.col("log_counts").alias("v")),
            F.struct(F.lit("f").alias("k"), F.col("log_feats").alias("v")),
            F.struct(F.lit("m").alias("k"), (1.0 / (1.0 + F.exp(-F.col("logit_mito")))).alias("v")),
            F.struct(F.lit("s").alias("k"), (1.0 / (1.0 + F.exp(-F.col("splice_ratio")))).alias("v")))))
    med = ordered.median_by(long, [batch, "k"], "v", "med")
    wide = med.groupBy(batch).agg(*[
        F.max(F.when(F.col("k") == k, F.col("med"))).alias(name)
        for k, name in (("c", "med_counts"), ("f", "med_feats"), ("m", "med_mito"), ("s", "med_splice"))])
    tags = n.join(wide, batch).withColumns({
        "n_cat": right_closed_bin(F.round(F.pow(F.lit(10.0), F.col("log_n"))), SIZE_BREAKS),
        "counts_cat": right_closed_bin(F.pow(F.lit(10.0), F.col("med_counts")), COUNT_BREAKS),
        "feats_cat": right_closed_bin(F.pow(F.lit(10.0), F.col("med_feats")), COUNT_BREAKS),
        "mito_cat": right_closed_bin("med_mito", SHARE_BREAKS),
        "splice_cat": right_closed_bin("med_splice", SHARE_BREAKS),
    })
    return cells.join(tags, batch)


def exclusion_shares(cells: DataFrame, cuts: DataFrame, batch: str = "batch") -> DataFrame:
    """Percent of cells outside the limits per batch, one column per metric."""
    bounds = cuts_long(cuts, batch).where(F.col("qc_var") != "n_cells")
    names = ["log_counts", "log_feats", "logit_mito", "logit_spliced"]
    long = metrics_long(cells, [batch], names).join(bounds, [batch, "qc_var"])
    out = F.count_if(~inside("qc_val", F.col("min"), F.col("max")))
    pct = long.groupBy(batch, "qc_var").agg(F.round(out / F.count(F.lit(1)) * 100.0, 1).alias("p"))
    return pct.groupBy(batch).agg(*[
        F.max(F.when(F.col("qc_var") == v, F.col("p"))).alias(f"pct_excluded_by_{v}") for v in names])


def qc_summary(cells: DataFrame, cuts: DataFrame, batch: str = "batch") -> DataFrame:
    """Cells before and after filtering per batch, percent lost, and percent outside each limit."""
    n = cells.groupBy(batch).agg(F.count(F.lit(1)).alias("n_pre_qc"), F.count_if("keep").alias("n_post_qc"))
    out = n.withColumns({
        "n_excluded": F.col("n_pre_qc") - F.col("n_post_qc"),
        "pct_excluded": F.round(100.0 * (1.0 - F.col("n_post_qc") / F.col("n_pre_qc")), 1),
        "excluded": F.col("n_post_qc") == 0,
    })
    return out.join(exclusion_shares(cells, cuts, batch), batch)


def exclusion_flags(cells: DataFrame, cuts: DataFrame, batch: str = "batch") -> DataFrame:
    """Per hard-kept cell 0/1 membership of the low and high side of each limit and ``passed_qc``."""
    # Short names of the metrics in the set labels.
    names = {"log_counts": "umis", "log_feats": "genes", "logit_mito": "mito", "logit_spliced": "spliced"}
    limits = {"log_counts": ("min_counts", None), "log_feats": ("min_feats", None),
              "logit_mito": ("min_mito", "max_mito"), "logit_spliced": ("min_splice", "max_splice")}
    x = cells.where("keep_hard").join(cuts, batch)
    flags = {}
    for metric, short in names.items():
        scale = log10_or_neg_inf if metric.startswith("log_") else logit
        lo, hi = limits[metric]
        flags[f"low_{short}"] = below(metric, scale(lo)).cast("int")
        if hi:
            flags[f"high_{short}"] = above(metric, scale(hi)).cast("int")
    return x.select(batch, "cell_id", *[v.alias(k) for k, v in flags.items()], F.col("keep").cast("int").alias("passed_qc"))


def exclusion_sets(cells: DataFrame, cuts: DataFrame, batch: str = "batch") -> DataFrame:
    """Sizes of all intersections of the exclusion sets."""
    flags = exclusion_flags(cells, cuts, batch)
    names = [c for c in flags.columns if c not in (batch, "cell_id")]
    return flags.groupBy(*names).agg(F.count(F.lit(1)).alias("n_cells"))


def totals_by_metadata(cells: DataFrame, meta: DataFrame, meta_vars: Sequence[str], sample: str = "sample_id",
                       donor: str = "subject_id") -> DataFrame:
    """Cells, samples and donors kept and lost per metadata value."""
    n = cells.groupBy(sample).agg(F.count(F.lit(1)).alias("pre_n"), F.count_if("keep").alias("post_n"))
    base = n.join(meta, sample)
    long = base.select(sample, donor, "pre_n", "post_n", *[F.col(v).cast("string") for v in meta_vars]).unpivot(
        [sample, donor, "pre_n", "post_n"], list(meta_vars), "meta_var", "meta_val")
    post = F.col("post_n") > 0
    pre = F.col("pre_n") > 0
    agg = long.groupBy("meta_var", "meta_val").agg(
        F.sum("pre_n").alias("pre_cells"), F.sum("post_n").alias("kept_cells"),
        F.count_if(pre).alias("pre_samples"), F.count_if(post).alias("kept_samples"),
        F.countDistinct(F.when(pre, F.col(donor))).alias("pre_donors"),
        F.countDistinct(F.when(post, F.col(donor))).alias("kept_donors"))
    rows = [F.struct(F.lit(k).alias("count_var"), F.col(f"kept_{k}").alias("kept"),
                     (F.col(f"pre_{k}") - F.col(f"kept_{k}")).alias("excluded")) for k in ("cells", "samples", "donors")]
    return agg.select("meta_var", "meta_val", F.inline(F.array(*rows)))


def metric_heatmap(cells: DataFrame, batch: str = "batch") -> DataFrame:
    """z-scored batch medians per metric with readable labels; shares are turned round."""
    long = metrics_long(cells, [batch], ["log_counts", "log_feats", "logit_mito", "splice_ratio"])
    med = ordered.median_by(long, [batch, "qc_var"], "qc_val", "med_val")
    size = cells.groupBy(batch).agg(F.log10(F.count(F.lit(1))).alias("med_val")).withColumn("qc_var", F.lit("log10_n"))
    both = med.unionByName(size)
    stats = both.groupBy("qc_var").agg(F.avg("med_val").alias("_m"), F.stddev_samp("med_val").alias("_s"))
    v = F.col("med_val")
    sign = F.when(F.col("qc_var").isin("logit_mito", "splice_ratio"), -1.0).otherwise(1.0)
    thousands = F.format_string("%.1fk", F.pow(F.lit(10.0), v) / 1000.0)
    label = (
        F.when(F.col("qc_var") == "logit_mito", F.format_string("%.1f%%", 100.0 / (1.0 + F.exp(-v))))
        .when(F.col("qc_var") == "splice_ratio", F.format_string("%.0f%%", 100.0 / (1.0 + F.pow(F.lit(2.0), v))))
        .otherwise(thousands)
    )
    return both.join(stats, "qc_var").select(
        batch, "qc_var", "med_val",
        (sign * (v - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s"))).alias("z"), label.alias("label"))

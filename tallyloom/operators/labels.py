"""Cluster labels: majority labels, confusion tables, mixing, sizes, classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import entropy_term, resolution_of, zero_pad
from tallyloom.operators import joins, ordered
from tallyloom.operators.ordered import as_list


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def with_share(df: DataFrame, by, value: str = "n", out: str = "prop") -> DataFrame:
    """Share of ``value`` within a group of an aggregated table."""
    return df.withColumn(out, F.col(value) / F.sum(value).over(Window.partitionBy(*as_list(by))))


def top_labels(preds: DataFrame, by, label: str = "predicted_label") -> DataFrame:
    """Most frequent label of each group with its share; ties by label."""
    keys = as_list(by)
    n = with_share(value_counts(preds, [*keys, label]), keys)
    best = n.groupBy(*keys).agg(
        F.min_by(F.struct(F.col(label), F.col("prop")), F.struct(-F.col("n"), F.col(label))).alias("_b"))
    return best.select(*keys, F.col(f"_b.{label}").alias(label), F.col("_b.prop").alias("prop"))


def majority_label(preds: DataFrame, clusters: DataFrame, min_prop: float = 0.5) -> DataFrame:
    """Label of each cluster by majority of its cells, ``ambiguous`` below ``min_prop``; cells keep their own label."""
    data = preds.join(clusters.where(F.col("hi_res_cl").isNotNull()).select("cell_id", "hi_res_cl"), "cell_id")
    top = top_labels(data, "hi_res_cl").select(
        "hi_res_cl",
        F.when(F.col("prop") < min_prop, "ambiguous").otherwise(F.col("predicted_label")).alias("predicted_label_agg"),
        F.col("prop").alias("prop_hi_res_cl"))
    return data.join(top, "hi_res_cl", "left").withColumnsRenamed(
        {"predicted_label": "predicted_label_naive", "probability": "probability_naive"})


def label_by_resolution(preds: DataFrame, clusters: DataFrame, res_cols: Sequence[str], min_prop: float = 0.5,
                        min_size: int = 0) -> DataFrame:
    """Majority label at every resolution, back to one row per cell.

    A label counts only with a share above ``min_prop`` in a cluster of at least ``min_size`` cells.
    """
    long = clusters.select("cell_id", *[F.col(c).cast("string") for c in res_cols]).unpivot(
        ["cell_id"], list(res_cols), "res", "cl").where(F.col("cl").isNotNull())
    sizes = long.groupBy("res", "cl").agg(F.count(F.lit(1)).alias("_n"))
    data = preds.select("cell_id", "predicted_label").join(long, "cell_id")
    top = top_labels(data, ["res", "cl"]).join(sizes.where(F.col("_n") >= min_size), ["res", "cl"], "left_semi")
    top = top.where((F.col("predicted_label") != "ambiguous") & (F.col("prop") > min_prop))
    cells = long.join(top, ["res", "cl"], "left").join(preds.select("cell_id"), "cell_id", "left_semi")
    aggs = []
    for c in res_cols:
        hit = F.col("res") == c
        aggs += [F.max(F.when(hit, F.col("cl"))).alias(f"cl_int_{c}"),
                 F.max(F.when(hit, F.col("predicted_label"))).alias(f"cl_pred_{c}"),
                 F.max(F.when(hit, F.col("prop"))).alias(f"prop_pred_{c}")]
    return cells.groupBy("cell_id").agg(*aggs)


def confusion(a: DataFrame, b: DataFrame, col_a: str, col_b: str, pseudo: float = 0.1, raw_shares: bool = True,
              min_best_share: float | None = None) -> DataFrame:
    """Cross table of two labelings with shares by row and column and their logs.

    ``raw_shares`` takes shares from the counts (logs always include the pseudo-count).
    ``min_best_share`` drops labels of ``a`` that nowhere reach that column share.
    """
    n = a.select("cell_id", F.col(col_a).alias("cl1")).join(b.select("cell_id", F.col(col_b).alias("cl2")), "cell_id")
    n = value_counts(n, ["cl1", "cl2"])
    if min_best_share is not None:
        best = with_share(n, "cl2").groupBy("cl1").agg(F.max("prop").alias("_p")).where(F.col("_p") >= min_best_share)
        n = n.join(best.select("cl1"), "cl1", "left_semi")
    full = joins.complete(n, ["cl1"], ["cl2"], {"n": 0}).withColumn("n0", F.col("n") + F.lit(pseudo).cast("double"))
    for side in ("cl1", "cl2"):
        w = Window.partitionBy(side)
        logged = F.col("n0") / F.sum("n0").over(w)
        plain = F.col("n") / F.sum("n").over(w) if raw_shares else logged
        full = full.withColumn(f"p_{side}", plain).withColumn(f"log_p_{side}", F.ln(logged))
    return full.withColumn("log_n", F.ln("n0"))


def cluster_entropy(cells: DataFrame, batch: str = "batch", cluster: str = "cluster") -> DataFrame:
    """Mixing of batches per cluster: raw and batch-size-normalised entropy, largest share, size."""
    n = value_counts(cells, [batch, cluster])
    by_cl = Window.partitionBy(cluster)
    x = n.withColumns({
        "_ps": F.col("n") / F.sum("n").over(Window.partitionBy(batch)),
        "_pc": F.col("n") / F.sum("n").over(by_cl)}).withColumn("_pn", F.col("_ps") / F.sum("_ps").over(by_cl))
    return x.groupBy(cluster).agg(
        (-F.sum(entropy_term("_pc"))).alias("h_cl_raw"), (-F.sum(entropy_term("_pn"))).alias("h_cl_norm"),
        (100.0 * F.max("_pc")).alias("max_pct_raw"), (100.0 * F.max("_pn")).alias("max_pct_norm"),
        F.sum("n").alias("n"))


def relabel_by_size(cells: DataFrame, cluster: str) -> DataFrame:
    """Rename clusters cl01, cl02, ... in decreasing size; equal sizes keep the order of their old names."""
    n = ordered.positions(value_counts(cells, [cluster]), None, "n", cluster, "_rank")
    names = n.select(F.col(cluster).alias("_old"), F.concat(F.lit("cl"), zero_pad(F.col("_rank"))).alias("_new"))
    return cells.join(names, cells[cluster] == names["_old"], "left").withColumn(cluster, F.col("_new")).drop("_old", "_new")


def cluster_by_metadata(cells: DataFrame, meta: DataFrame, meta_vars: Sequence[str], sample: str = "sample_id") -> DataFrame:
    """Cells per cluster and metadata value, and their share within (variable, cluster).

    Counted per sample first; the metadata is unfolded on the small table.
    """
    n = joins.complete(value_counts(cells, [sample, "cluster"]), [sample], ["cluster"], {"n": 0})
    long = meta.select(sample, *[F.col(v).cast("string") for v in meta_vars]).unpivot([sample], list(meta_vars), "meta_var", "meta_val")
    out = n.join(long, sample).groupBy("meta_var", "meta_val", "cluster").agg(F.sum("n").alias("n"))
    tot = F.sum("n").over(Window.partitionBy("meta_var", "cluster"))
    return out.withColumn("prop", F.when(tot > 0, F.col("n") / F.when(tot > 0, tot)))


def doublet_clusters(cells: DataFrame, cluster: str = "cluster", max_prop: float = 0.5) -> DataFrame:
    """Doublet share of each cell's cluster, flag above ``max_prop``, and whether the cell stays."""
    share = cells.groupBy(cluster).agg(
        (F.count_if("is_dbl") / F.count(F.lit(1))).alias("dbl_prop"), F.count(F.lit(1)).alias("dbl_cl_size"))
    out = cells.join(share, cluster).withColumn("in_dbl_cl", F.col("dbl_prop") > max_prop)
    return out.withColumn("keep", ~F.col("is_dbl") & ~F.col("in_dbl_cl"))


def doublet_cluster_share(cells: DataFrame, cluster: str = "cluster") -> DataFrame:
    return cells.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("dbl_cl_size"), (100.0 * F.count_if("is_dbl") / F.count(F.lit(1))).alias("dbl_pct"))


def drop_small_groups(df: DataFrame, by, min_size: int) -> DataFrame:
    """Rows of groups with at least ``min_size`` rows (count and semi join, no window over rows)."""
    keys = as_list(by)
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_size).select(*keys)
    return df.join(big, keys, "left_semi")


def classify_cells(logcounts: DataFrame, model: DataFrame, intercepts: DataFrame, value: str = "logcount", cells: DataFrame | None = None,
                   scaling: DataFrame | None = None) -> DataFrame:
    """Best class and its probability per cell from a linear model held as a long table.

    ``model`` is (class, gene_id, weight), ``intercepts`` is (class, intercept). The model is folded to one
    row per gene with an array of weights in the order of the classes, so a count meets its gene once; the
    arrays are summed per cell. A cell of ``cells`` (default: those with counts) without a gene of the model
    scores the intercepts. ``scaling`` (gene_id, centre, scale) centres and scales the values as the model
    was trained; absent counts are zeros and are centred as well.
    """
    bias = intercepts.agg(F.array_sort(F.collect_list(F.struct("class", "intercept"))).alias("b"))  # a row per class
    flat = model.join(intercepts.select("class"), "class")
    if scaling is not None:
        flat = flat.join(scaling, "gene_id", "left").withColumn("weight", F.col("weight") / F.coalesce("scale", F.lit(1.0)))
        shift = flat.groupBy("class").agg(F.sum(F.col("weight") * F.coalesce("centre", F.lit(0.0))).alias("_c"))
        moved = intercepts.join(shift, "class", "left").select("class", (F.col("intercept") - F.coalesce("_c", F.lit(0.0))).alias("intercept"))
        bias = moved.agg(F.array_sort(F.collect_list(F.struct("class", "intercept"))).alias("b"))
    bias = bias.scalar()
    by_gene = flat.groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct("class", "weight"))).alias("_m"))
    by_gene = by_gene.withColumn("_b", bias).select("gene_id", F.transform("_b", lambda c: F.coalesce(F.try_element_at("_m", c["class"]), F.lit(0.0))).alias("_w"))
    n = len(intercepts.select("class").distinct().collect())  # the classes of the model
    sums = logcounts.join(by_gene, "gene_id").groupBy("cell_id").agg(
        F.array(*[F.sum(F.col(value) * F.element_at("_w", i + 1)) for i in range(n)]).alias("_s"))
    every = (cells if cells is not None else logcounts).select("cell_id").distinct()
    score = F.transform("_b", lambda c, i: F.struct(
        (F.coalesce(F.element_at("_s", i + 1), F.lit(0.0)) + c["intercept"]).alias("t"), c["class"].alias("class")))
    scored = every.join(sums, "cell_id", "left").withColumn("_b", bias).withColumn("_t", score)
    # the highest score; between equal ones the first class
    best = F.array_sort("_t", lambda a, b: F.when(a["t"] > b["t"], -1).when(a["t"] < b["t"], 1).when(a["class"] < b["class"], -1).otherwise(1))
    return scored.withColumn("_b", F.element_at(best, 1)).select(
        "cell_id", F.col("_b.class").alias("predicted_label"), (1.0 / (1.0 + F.exp(-F.col("_b.t")))).alias("probability"))


def subset_sample_stats(cells: DataFrame, batches: DataFrame, earlier: DataFrame, min_cells: int, batch: str = "batch") -> DataFrame:
    """Selected cells per batch (absent batches as zero), too few or bad before means bad."""
    n = cells.groupBy(batch).agg(F.count(F.lit(1)).alias("n_cells"))
    out = joins.attach(batches.select(batch).distinct(), n, batch, {"n_cells": 0})
    out = out.join(earlier.select(batch, F.col(f"bad_{batch}").alias("_bad")), batch, "left")
    return out.withColumn(f"bad_{batch}", (F.col("n_cells") < min_cells) | F.coalesce("_bad", F.lit(False))).drop("_bad")


def resolutions(columns: DataFrame, name: str = "column") -> DataFrame:
    return columns.withColumn("resolution", resolution_of(name))

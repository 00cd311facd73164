"""Highly variable genes: variance trend, clipped variance, ranking over batches."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators import counts as C
from tallyloom.operators import ordered
from tallyloom.operators.ordered import as_list
from tallyloom.session import cut_lineage

FLAT = 1e-10  # determinants of the normal equations up to this count as zero

def quantiles_with_zeros(gene_sums: DataFrame, n_cells: DataFrame, probs: Mapping[str, float], by="batch") -> DataFrame:
    """Quantiles of counts per gene over all cells of the group; zeros only shift the order statistics."""
    keys = [*as_list(by), "gene_id"]
    runs = gene_sums.where("count > 0").groupBy(*keys, "count").agg(F.count(F.lit(1)).alias("n"))
    cum = F.sum("n").over(Window.partitionBy(*keys).orderBy("count").rowsBetween(Window.unboundedPreceding, 0))
    nonzero = F.sum("n").over(Window.partitionBy(*keys))
    x = runs.withColumns({"cum": cum, "k": nonzero}).join(n_cells, as_list(by)).withColumn("z", F.col("n_cells") - F.col("k"))
    aggs, out = [], []
    for name, p in probs.items():
        at = (F.col("n_cells") - 1) * F.lit(float(p))
        lo = F.floor(at)
        hi = F.least(lo + 1, F.col("n_cells") - 1)
        aggs += [F.min(F.when(F.col("cum") + F.col("z") > lo, F.col("count"))).alias(f"_{name}_a"),
                 F.min(F.when(F.col("cum") + F.col("z") > hi, F.col("count"))).alias(f"_{name}_b")]
        a = F.when(lo < F.col("z"), 0.0).otherwise(F.col(f"_{name}_a"))
        b = F.when(hi < F.col("z"), 0.0).otherwise(F.col(f"_{name}_b"))
        out.append((a + (b - a) * (at - lo)).alias(name))
    wide = x.groupBy(*keys, "n_cells", "z").agg(*aggs)
    return wide.select(*keys, *out)


def _tree_cuts(n: Column, leaf: Column, share: float) -> Column:
    """Ranks behind which cells of more than ``leaf`` of n sorted points are halved, again and again."""
    cells = F.array(F.struct(F.lit(1).cast("long").alias("l"), n.alias("u")))
    for _ in range(math.ceil(math.log2(2 / share)) + 1):
        cells = F.flatten(F.transform(cells, lambda c: F.when(
            c["u"] - c["l"] + 1 > leaf,
            F.array(F.struct(c["l"].alias("l"), F.floor((c["l"] + c["u"]) / 2).alias("u")),
                    F.struct((F.floor((c["l"] + c["u"]) / 2) + 1).alias("l"), c["u"].alias("u"))),
        ).otherwise(F.array(c))))
    return F.transform(cells, lambda c: c["u"])


def _vertex_fit(keys: list[str], points: DataFrame, vertices: DataFrame) -> DataFrame:
    """Tricube-weighted quadratic fit at each vertex: value and slope.

    ``vertices`` holds one row per group with ``_q`` and an array of places, so that a group of any size is
    spread over the tasks that hold its points. The distance to the q-th nearest point is the least of the
    larger end distances of all runs of q neighbouring points.
    """
    a, b = points.select(*keys, "_pos", F.col("_x").alias("_a")), points.select(*keys, "_pos", F.col("_x").alias("_b"))
    ends = (a.join(vertices.select(*keys, "_q"), keys).withColumn("_pos", F.col("_pos") + F.col("_q") - 1)
            .join(b, [*keys, "_pos"]).join(vertices.select(*keys, F.explode("_v").alias("_at")), keys))
    reach = ends.groupBy(*keys, "_at").agg(F.min(F.greatest(F.abs(F.col("_a") - F.col("_at")), F.abs(F.col("_b") - F.col("_at")))).alias("_h"))
    reach = reach.groupBy(*keys).agg(F.collect_list(F.struct("_at", (F.col("_h") * 1.0000001).alias("_h"))).alias("_v"))
    d = F.abs(F.col("_x") - F.col("_at"))
    near = points.join(reach, keys).select(*keys, "_x", "_y", F.inline("_v")).where(d <= F.col("_h"))
    u = F.when(F.col("_h") > 0, (F.col("_x") - F.col("_at")) / F.col("_h")).otherwise(0.0)
    near = near.withColumns({"_u": u, "_w": F.pow(1 - F.pow(F.abs(u), 3), 3)})
    m = {f"m{k}": F.sum(F.col("_w") * F.pow("_u", F.lit(k))) / F.sum("_w") for k in range(1, 5)}
    m |= {f"y{k}": F.sum(F.col("_w") * F.pow("_u", F.lit(k)) * F.col("_y")) / F.sum("_w") for k in range(3)}
    sums = near.groupBy(*keys, "_at", "_h").agg(*[e.alias(k) for k, e in m.items()])
    # normal equations; a straight line or the mean where the points lie at two places or one
    sums = sums.withColumns({
        "_d2": F.expr("m2 - m1 * m1"),
        "_d3": F.expr("(m2 * m4 - m3 * m3) - m1 * (m1 * m4 - m2 * m3) + m2 * (m1 * m3 - m2 * m2)"),
    })
    value = F.expr(f"""CASE WHEN _d3 > {FLAT} THEN (y0 * (m2 * m4 - m3 * m3) - m1 * (y1 * m4 - m3 * y2) + m2 * (y1 * m3 - m2 * y2)) / _d3
        WHEN _d2 > {FLAT} THEN (y0 * m2 - m1 * y1) / _d2 ELSE y0 END""")
    slope = F.expr(f"""CASE WHEN _d3 > {FLAT} THEN ((y1 * m4 - m3 * y2) - y0 * (m1 * m4 - m2 * m3) + m2 * (m1 * y2 - m2 * y1)) / _d3 / _h
        WHEN _d2 > {FLAT} THEN (y1 - m1 * y0) / _d2 / _h ELSE 0 END""")
    return sums.select(*keys, F.col("_at"), value.alias("_val"), slope.alias("_slope"))


def local_regression(points: DataFrame, by="batch", span: float = 0.3, cell: float = 0.2, margin: float = 0.005) -> DataFrame:
    """Local quadratic regression of ``_y`` on ``_x``: one row per group with ``_curve``, an array of (_at, _val, _slope).

    A one-dimensional k-d tree: cells with more than span * cell of the group's points are halved at their
    median. Fits at the borders of the cells use the nearest ``span`` of all points of the group; cubics that
    keep values and slopes blend them in between. The number of borders depends on span and cell alone, and points are
    ranked by written ranges, so all points of a group are many tasks' work.
    """
    keys = as_list(by)
    placed = cut_lineage(ordered.positions(points.select(*keys, "_x", "_y"), keys, "_x", "_y", "_pos", descending=False))
    n = F.count(F.lit(1))
    lo, hi = F.min("_x"), F.max("_x")
    edge = margin * F.greatest(hi - lo, F.greatest(F.abs(lo), F.abs(hi)) * 1e-3 + 1e-30)
    box = placed.groupBy(*keys).agg(
        n.alias("_n"), F.greatest(F.lit(1), F.floor(n * span * cell)).cast("long").alias("_leaf"),
        F.least(n, F.greatest(F.lit(3), F.floor(n * span + 1e-5))).cast("long").alias("_q"),
        (lo - edge).alias("_lo"), (hi + edge).alias("_hi"))
    cuts = box.select(*keys, "_n", F.explode(_tree_cuts(F.col("_n"), F.col("_leaf"), span * cell)).alias("_cut")).where("_cut < _n")
    sides = cuts.select(*keys, "_cut", F.explode(F.array("_cut", F.col("_cut") + 1)).alias("_pos"))
    inner = sides.join(placed, [*keys, "_pos"]).groupBy(*keys, "_cut").agg((F.sum("_x") / 2).alias("_at"))
    inner = inner.groupBy(*keys).agg(F.collect_set("_at").alias("_inner"))  # at most some dozens a group
    vertices = cut_lineage(box.join(inner, keys, "left").select(
        *keys, "_q", F.array_distinct(F.concat(F.array("_lo", "_hi"), F.coalesce("_inner", F.array().cast("array<double>")))).alias("_v")))
    fits = _vertex_fit(keys, placed, vertices)
    # a row per group; written, so that Spark knows their size and need not send the points of a group to one task to meet them
    return cut_lineage(fits.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_at", "_val", "_slope"))).alias("_curve")))


def _on_curve(curve: Column, x: Column) -> Column:
    """Cubic between the two places around x, which are looked for once a row (each use of the number of
    a place outside of ``transform`` would look for it again)."""
    place = F.greatest(F.lit(1), F.least(F.size(curve) - 1, F.size(F.filter(curve, lambda c: c["_at"] <= x))))
    ends = F.transform(F.array(place), lambda i: F.struct(F.element_at(curve, i).alias("a"), F.element_at(curve, i + 1).alias("b")))

    def cubic(e: Column) -> Column:
        a, b = e["a"], e["b"]
        h = b["_at"] - a["_at"]
        t = (x - a["_at"]) / h
        return ((1 + 2 * t) * (1 - t) * (1 - t) * a["_val"] + t * (1 - t) * (1 - t) * h * a["_slope"]
                + t * t * (3 - 2 * t) * b["_val"] + t * t * (t - 1) * h * b["_slope"])

    return F.element_at(F.transform(ends, cubic), 1)


def _with_trend(df: DataFrame) -> DataFrame:
    reg = F.sqrt(F.pow(F.lit(10.0), F.col("estimated_variance")))
    return df.withColumn("reg_std", reg).withColumn(
        "clip_val", F.col("reg_std") * F.sqrt(F.col("n_cells").cast("double")) + F.col("mean"))


def variance_trend(gene_var: DataFrame, by="batch", span: float = 0.3, trend: str = "loess") -> DataFrame:
    """Expected variance per gene: local regression of log10 variance on log10 mean, per group.

    Equal points count once. Genes without mean or variance get 0.
    ``trend='linear'`` fits a straight line with plain aggregates instead.
    """
    keys = as_list(by)
    src = cut_lineage(gene_var.withColumns({  # a row per gene and group; both the trend and its use read it
        "_x": F.log10(F.when(F.col("variance") > 0, F.when(F.col("mean") > 0, F.col("mean")))),
        "_y": F.log10(F.when(F.col("variance") > 0, F.col("variance"))),
    }))
    points = src.where("_x IS NOT NULL AND _y IS NOT NULL").select(*keys, "_x", "_y").distinct()
    if trend == "linear":
        line = points.groupBy(*keys).agg(F.regr_slope("_y", "_x").alias("_b"), F.regr_intercept("_y", "_x").alias("_a"))
        est = F.coalesce(F.col("_a") + F.col("_b") * F.col("_x"), F.lit(0.0))
        return _with_trend(src.join(line, keys).withColumn("estimated_variance", est)).drop("_x", "_y", "_a", "_b")
    src = src.join(local_regression(points, keys, span), keys, "left")
    est = F.when(F.col("_x").isNotNull(), _on_curve(F.col("_curve"), F.col("_x"))).otherwise(0.0)
    return _with_trend(src.withColumn("estimated_variance", est).drop("_x", "_y", "_curve"))


def standardised_variance(gene_var: DataFrame, clipped: DataFrame, by="batch") -> DataFrame:
    """Variance of clipped counts around the mean in units of the expected variance."""
    n, m = F.col("n_cells"), F.col("mean")
    num = n * m * m + F.col("squared_counts_sum") - 2 * F.col("counts_sum") * m
    den = (n - 1) * F.col("reg_std") * F.col("reg_std")
    return gene_var.join(clipped, [*as_list(by), "gene_id"]).withColumn(
        "variances_norm", F.when(den > 0, num / F.when(den > 0, den)))


def gene_variances(gene_sums: DataFrame, n_cells: DataFrame, by="batch", span: float = 0.3, trend: str = "loess") -> DataFrame:
    """Moments, trend, clipped sums and standardised variance in one go.

    The moments and their trend (one row per gene and group) are written once; the counts are
    read a second time for the clipped sums.
    """
    stats = cut_lineage(variance_trend(C.gene_mean_var(gene_sums, n_cells, by), by, span, trend))
    return standardised_variance(stats, C.clipped_sums(gene_sums, stats, by), by)


def excluded_genes(ambient: DataFrame | None = None, listed: DataFrame | None = None) -> DataFrame | None:
    """Union of ambient genes and genes from a list."""
    parts = []
    if ambient is not None:
        parts.append(ambient.where("is_ambient").select("gene_id"))
    if listed is not None:
        parts.append(listed.select("gene_id"))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def highly_variable_genes(stats: DataFrame, n: int = 2000, by="batch", exclude: DataFrame | None = None) -> DataFrame:
    """Rank genes by standardised variance within each group, then over the groups; flag the top n.

    Excluded genes keep a NULL rank. With one group the order is that of its ranks; with several
    it is the number of groups that rank the gene among their first n, then the median rank.
    Ties are settled by gene_id.
    """
    keys = as_list(by)
    src = cut_lineage(stats.select(*keys, "gene_id", "variances_norm"))
    if exclude is not None:
        src = src.join(exclude.select("gene_id").distinct().withColumn("_out", F.lit(True)), "gene_id", "left")
    else:
        src = src.withColumn("_out", F.lit(None).cast("boolean"))
    src = src.withColumn("_v", F.when(F.col("_out").isNull(), F.col("variances_norm")))
    ranked = ordered.mid_rank(src, keys, "_v", "_rank", bounded=True)
    n_groups = src.select(*keys).distinct().agg(F.count(F.lit(1)).alias("k")).scalar()
    genes = ranked.groupBy("gene_id").agg(
        F.count_if(F.col("_rank") <= n).alias("_hits"),
        F.median("_rank").alias("highly_variable_rank"),
        F.avg("variances_norm").alias("variances_norm"),
    ).withColumn("highly_variable_nbatches", F.when(n_groups == 1, F.lit(1)).otherwise(F.col("_hits")).cast("long")).drop("_hits")
    order = [F.col("highly_variable_nbatches").desc(), F.col("highly_variable_rank").asc_nulls_last(), F.col("gene_id").asc()]
    top = genes.orderBy(*order).limit(n).select("gene_id", F.lit(True).alias("_top"))
    return genes.join(top, "gene_id", "left").withColumn("highly_variable", F.coalesce("_top", F.lit(False))).drop("_top")


def hvg_status(hvgs: DataFrame, ambient: DataFrame) -> DataFrame:
    """Per gene: hvg, dirty (ambient) or boring, with the effect in empties."""
    a = ambient.select("gene_id", F.col("logFC").alias("log2fc"), F.col("FDR").alias("padj"), "is_ambient")
    out = hvgs.join(a, "gene_id", "left").withColumns({
        "is_ambient": F.coalesce(F.col("padj").isNotNull() & F.col("is_ambient"), F.lit(False)),
        "log2fc": F.when(F.col("padj").isNull(), 0.0).otherwise(F.col("log2fc")),
    })
    status = F.when(F.col("highly_variable"), "hvg").when(F.col("is_ambient"), "dirty").otherwise("boring")
    return out.select("gene_id", "log2fc", "padj", F.col("highly_variable_nbatches").alias("hv_n"),
                      F.col("variances_norm").alias("mean_var"), F.col("highly_variable").alias("is_hvg"), "is_ambient",
                      status.alias("status"))


def hvg_counts(gene_sums: DataFrame, hvgs: DataFrame, cells: DataFrame) -> DataFrame:
    """Counts of the selected genes for the given cells (kept cells, or doublets)."""
    picked = hvgs.where("highly_variable").select("gene_id")
    return gene_sums.join(picked, "gene_id", "left_semi").join(cells.select("cell_id"), "cell_id", "left_semi")

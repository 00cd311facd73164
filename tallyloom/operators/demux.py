"""Sample tags (hashing oligos): checks, normalisation, assignment of cells to tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.stats import nb_cut
from tallyloom.operators import joins
from tallyloom.session import cut_lineage


def complete_tags(tags: DataFrame) -> DataFrame:
    """One row per cell and tag of its pool, absent counts as 0. A pool has a handful of tags."""
    per_pool = tags.groupBy("pool_id").agg(F.array_sort(F.collect_set("hto_id")).alias("_t"))
    cells = tags.groupBy("pool_id", "cell_id").agg(F.map_from_entries(F.collect_list(F.struct("hto_id", "count"))).alias("_m"))
    grid = cells.join(per_pool, "pool_id").select("pool_id", "cell_id", "_m", F.explode("_t").alias("hto_id"))
    return grid.select("pool_id", "cell_id", "hto_id", F.coalesce(F.element_at("_m", F.col("hto_id")), F.lit(0)).cast("double").alias("count"))


def tag_medians(tags: DataFrame) -> DataFrame:
    """Median count per pool and tag over all cells of the pool, zeros included.

    Counts are whole numbers, so equal counts fold together and zeros only shift the order.
    """
    n = tags.groupBy("pool_id").agg(F.countDistinct("cell_id").alias("n_cells"))
    runs = tags.where("count > 0").groupBy("pool_id", "hto_id", "count").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("pool_id", "hto_id")
    x = runs.withColumns({"cum": F.sum("n").over(w.orderBy("count").rowsBetween(Window.unboundedPreceding, 0)), "k": F.sum("n").over(w)})
    x = x.join(n, "pool_id").withColumn("z", F.col("n_cells") - F.col("k"))
    lo, hi = F.floor((F.col("n_cells") - 1) / 2.0), F.ceil((F.col("n_cells") - 1) / 2.0)
    y = x.groupBy("pool_id", "hto_id", "n_cells", "z").agg(
        F.min(F.when(F.col("cum") + F.col("z") > lo, F.col("count"))).alias("a"),
        F.min(F.when(F.col("cum") + F.col("z") > hi, F.col("count"))).alias("b"))
    a = F.when(lo < F.col("z"), 0.0).otherwise(F.col("a").cast("double"))
    b = F.when(hi < F.col("z"), 0.0).otherwise(F.col("b").cast("double"))
    return y.select("pool_id", "hto_id", ((a + b) / 2.0).alias("median_count"))


def check_tags(tags: DataFrame, expected: DataFrame, least: float = 1.0) -> DataFrame:
    """Per pool and tag: ``error`` (expected tag too low), ``drop`` (unexpected and low) or ``ok``."""
    want = expected.select("pool_id", "hto_id").distinct().withColumn("_e", F.lit(True))
    x = tag_medians(tags).join(want, ["pool_id", "hto_id"], "left")
    low = F.col("median_count") < least
    status = F.when(low & F.col("_e").isNotNull(), "error").when(low, "drop").otherwise("ok")
    return x.select("pool_id", "hto_id", "median_count", F.col("_e").isNotNull().alias("expected"), status.alias("status"))


def clr_normalise(tags: DataFrame) -> DataFrame:
    """Centred log ratio per tag: ln(x / exp(mean ln(1 + x)) + 1), the mean over all cells of the pool."""
    n = tags.groupBy("pool_id").agg(F.countDistinct("cell_id").alias("_n"))
    s = tags.groupBy("pool_id", "hto_id").agg(F.sum(F.log1p(F.col("count").cast("double"))).alias("_s"))
    g = s.join(n, "pool_id").select("pool_id", "hto_id", F.exp(F.col("_s") / F.col("_n")).alias("_g"))
    return tags.join(g, ["pool_id", "hto_id"]).withColumn("norm_count", F.log1p(F.col("count") / F.col("_g"))).drop("_g")


def hto_long(tags: DataFrame) -> DataFrame:
    """Normalised count, count and share of the cell's tag counts."""
    tot = tags.groupBy("pool_id", "cell_id").agg(F.sum("count").alias("hto_total"))
    return clr_normalise(tags).join(tot, ["pool_id", "cell_id"]).withColumn("prop", F.col("count") / F.col("hto_total"))


def hto_demux(tags: DataFrame, quantile: float = 0.99, rounds: int = 10) -> DataFrame:
    """Class (negative, singlet, doublet) and best tag of every cell, pool by pool.

    The cells of a pool are clustered on the normalised counts of the pool's own tags (tags + 1 clusters:
    a cell starts at its best tag, or at none when its lead over the next is under half of the pool's mean lead;
    ``rounds`` rounds of k-means, centres as a long table, for all pools at once). For each pool and tag the cluster with the
    lowest mean is its background; a negative binomial fitted to the background counts gives the cut above
    which a cell is positive for the tag.
    """
    full = cut_lineage(clr_normalise(complete_tags(tags)))
    key = ["pool_id", "cell_id"]
    two = F.slice(F.sort_array(F.collect_list(F.struct("norm_count", "hto_id")), False), 1, 2)  # a row per tag of the pool
    best = full.groupBy(*key).agg(two.alias("_b")).withColumn("_lead", F.col("_b")[0]["norm_count"] - F.coalesce(F.try_element_at("_b", F.lit(2))["norm_count"], F.lit(0.0)))
    usual = best.groupBy("pool_id").agg((F.avg("_lead") / 2).alias("_u"))
    cl = best.join(usual, "pool_id").select(*key, F.when(F.col("_lead") >= F.col("_u"), F.col("_b")[0]["hto_id"]).otherwise("").alias("_k"))
    for _ in range(rounds):
        cl = cut_lineage(cl)
        centres = full.join(cl, key).groupBy("pool_id", "_k", "hto_id").agg(F.avg("norm_count").alias("_m"))
        away = full.join(centres, ["pool_id", "hto_id"]).groupBy(*key, "_k").agg(F.sum((F.col("norm_count") - F.col("_m")) ** 2).alias("_d"))
        cl = away.groupBy(*key).agg(F.min_by("_k", F.struct("_d", "_k")).alias("_k"))
    x = full.join(cut_lineage(cl), key)
    stats = x.groupBy("pool_id", "hto_id", "_k").agg(
        F.avg("norm_count").alias("_m"), F.avg("count").alias("mean"), F.coalesce(F.var_samp("count"), F.lit(0.0)).alias("variance"))
    bg = stats.groupBy("pool_id", "hto_id").agg(F.min_by(F.struct("mean", "variance"), F.struct("_m", "_k")).alias("b"))
    cut = bg.select("pool_id", "hto_id", nb_cut("b.mean", "b.variance", F.lit(float(quantile))).alias("cut"))
    pos = x.join(cut, ["pool_id", "hto_id"]).withColumn("_pos", F.col("count") > F.col("cut"))
    out = pos.groupBy("pool_id", "cell_id").agg(
        F.count_if("_pos").alias("n_pos"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("_pos"), F.col("hto_id")))), "_").alias("hto_classification"),
        F.max_by("hto_id", F.struct(F.col("norm_count"), F.col("hto_id"))).alias("guess"))
    cls = F.when(F.col("n_pos") == 0, "negative").when(F.col("n_pos") == 1, "singlet").otherwise("doublet")
    return out.withColumn("demux_class", cls).withColumn(
        "hto_classification", F.when(F.col("n_pos") == 0, "Negative").otherwise(F.col("hto_classification")))


def hto_summary(demux: DataFrame) -> DataFrame:
    """Cells per guess and percent of the pool."""
    n = demux.groupBy("pool_id", "guess").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("pool_id")))


def class_table(demux: DataFrame, cls: str = "demux_class") -> DataFrame:
    """Cells per pool in one column per class."""
    names = ["singlet", "doublet", "negative"]
    return demux.groupBy("pool_id").agg(*[F.count_if(F.col(cls) == c).alias(c) for c in names])


def attach_demux(cells: DataFrame, demux: DataFrame, valid: DataFrame) -> DataFrame:
    """Demultiplexing results on all cells; cells without a result are negative; flag valid (tag, pool) pairs."""
    out = cells.join(demux.select("cell_id", "pool_id", "guess", "demux_class"), ["cell_id", "pool_id"], "left")
    out = out.withColumns({"demux_class": F.coalesce("demux_class", F.lit("negative")), "hto_id": F.coalesce("guess", F.lit("Negative"))}).drop("guess")
    return joins.membership_flag(out, valid, ["hto_id", "pool_id"], "valid_hto")

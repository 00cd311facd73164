"""Barcode-rank curves: knees, inflections ("shins"), droplet parameters, empty plateau.

All work after the first aggregation happens on one row per run and distinct total, so its
size is bounded by the largest total, not by the number of barcodes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import ln_factorial, share_logit
from tallyloom.operators import joins, ordered
from tallyloom.session import cut_lineage

# Lower bounds tried for the first knee, barcodes skipped at the left end of the
# curve, number of cuts for the second knee, and the lowest total of its curve.
FIRST_LOWERS = tuple(range(1000, 0, -100))
SKIP_RANKS = 50
SECOND_CUTS = 10
MIN_UMIS_EMPTY = 5
LN10 = 2.302585092994046


def barcode_ranks(totals: DataFrame, run: str = "run_id") -> DataFrame:
    """Mean rank of each barcode by decreasing total within its run."""
    return ordered.mid_rank(totals, run, "total", "rank", descending=True)


def rank_curve(totals: DataFrame, run: str = "run_id") -> DataFrame:
    """One row per distinct total: barcodes with it, cumulative barcodes, mean rank.

    Every later step starts from this small table, so it is written once.
    """
    runs = ordered.running_counts(totals, run, "total", descending=True)
    return cut_lineage(
        runs.select(run, "total", "n", "cum", (F.col("cum") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)).alias("rank")))


def _knee_and_shin(points: DataFrame, keys: Sequence[str], skip: float = SKIP_RANKS) -> DataFrame:
    """Per key the inflection (steepest fall) and the knee (farthest above the chord) of a log-log curve."""
    keys = list(keys)
    step = Window.partitionBy(*keys).orderBy("rank")
    p = points.select(*keys, "total", "rank", F.log10("rank").alias("x"), F.log10("total").alias("y"))
    p = p.withColumn("slope", (F.lead("y").over(step) - F.col("y")) / (F.lead("x").over(step) - F.col("x")))
    late = F.when(F.col("rank") > skip, 0).otherwise(1)
    spot = F.struct("total", "rank", "x", "y")
    # the steepest fall past the skipped ranks; when all are skipped, the last one
    steep = F.struct(late.alias("a"), F.when(F.col("rank") > skip, F.col("slope")).otherwise(-F.col("rank")).alias("b"), F.col("rank"))
    whole = Window.partitionBy(*keys)
    has_slope = F.col("slope").isNotNull()
    p = p.withColumn("r", F.min_by(spot, F.when(has_slope, steep)).over(whole))
    on_left = has_slope & (F.col("rank") <= F.col("r.rank")) & ((F.col("rank") > skip) | (F.col("rank") == F.col("r.rank")))
    p = p.withColumn("l", F.max_by(spot, F.when(on_left, F.struct(F.col("slope"), -F.col("rank")))).over(whole))
    z = p.where(F.col("rank").between(F.col("l.rank"), F.col("r.rank")))
    run = F.col("r.x") - F.col("l.x")
    chord = F.when(run > 0, F.col("l.y") + (F.col("x") - F.col("l.x")) * (F.col("r.y") - F.col("l.y")) / F.when(run > 0, run)).otherwise(F.col("y"))
    gap = F.round(F.col("y") - chord, 9)
    return z.groupBy(*keys).agg(
        F.first("r.total").alias("shin"), F.max_by("total", F.struct(gap.alias("g"), -F.col("rank"))).alias("knee"))


def first_knee_votes(curve: DataFrame, lowers: Sequence[int] = FIRST_LOWERS, run: str = "run_id") -> DataFrame:
    """Knee and shin for every lower bound."""
    pts = curve.withColumn("lower", F.explode(F.lit(list(lowers)))).where(F.col("total") > F.col("lower"))
    return _knee_and_shin(pts, [run, "lower"])


def first_knee(curve: DataFrame, lowers: Sequence[int] = FIRST_LOWERS, run: str = "run_id",
               given: DataFrame | None = None) -> DataFrame:
    """(shin1, knee1) with most votes over the lower bounds, and the rank at shin1.

    ``given`` may hold knee1 and shin1 per run; those runs take the given pair.
    """
    votes = first_knee_votes(curve, lowers, run).groupBy(run, "shin", "knee").agg(F.count(F.lit(1)).alias("votes"))
    name = F.concat_ws("_", F.col("shin").cast("string"), F.col("knee").cast("string"))
    best = cut_lineage(joins.first_per_group(votes.withColumn("_name", name), run, [F.col("votes").desc(), F.col("_name").asc()]))
    best = best.select(run, F.col("shin").alias("shin1"), F.col("knee").alias("knee1"), "votes")
    if given is not None:
        best = best.join(given.select(run, F.col("shin1").alias("_s"), F.col("knee1").alias("_k")), run, "left").select(
            run, F.coalesce("_s", "shin1").alias("shin1"), F.coalesce("_k", "knee1").alias("knee1"), "votes")
    at = joins.nearest(curve.select(run, "total", "rank"), best, run, "total", "shin1", "rank")
    # one row per run, read by every later step
    return cut_lineage(best.join(at.select(run, F.col("rank").alias("shin1_x")), run))


def _log_mean_index(curve: DataFrame, bounds: DataFrame, lo: str, hi: str, out: str, run: str) -> DataFrame:
    """10^mean(log10(i)) over the row numbers i of barcodes whose rank lies in [lo, hi].

    The rows are contiguous, so the sum of logs is a difference of log factorials.
    """
    span = (
        curve.join(bounds.select(run, lo, hi), run).where(F.col("rank").between(F.col(lo), F.col(hi)))
        .groupBy(run).agg(F.min(F.col("cum") - F.col("n")).alias("_a"), F.max("cum").alias("_b"))
    )
    mean = (ln_factorial("_b") - ln_factorial("_a")) / (F.col("_b") - F.col("_a")) / LN10
    return span.select(run, F.pow(F.lit(10.0), mean).alias(out))


def second_knee(curve: DataFrame, first: DataFrame, min_umis: int = MIN_UMIS_EMPTY, n_cuts: int = SECOND_CUTS,
                run: str = "run_id", given: DataFrame | None = None) -> DataFrame:
    """(shin2, knee2) of the curve past a series of rank cuts, and the rank at knee2."""
    tail = Window.partitionBy(run).orderBy(F.col("total").asc())
    # third distinct total from the end leaves enough points for a curve
    last = (
        curve.where(F.col("total") > min_umis).withColumn("_i", F.row_number().over(tail)).where("_i <= 3")
        .groupBy(run).agg(F.max_by("rank", "_i").alias("last_x"))
    )
    bounds = first.select(run, "shin1_x").join(last, run)
    mid = _log_mean_index(curve, bounds, "shin1_x", "last_x", "middle", run)
    step = F.log10(F.col("middle") / F.col("shin1_x")) / float(n_cuts - 1)
    cuts = bounds.join(mid, run).select(
        run, F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_cuts - 1)), lambda i: F.struct(
            i.alias("cut_no"), (F.col("shin1_x") * F.pow(F.lit(10.0), step * i)).alias("cut")))).alias("_c")).select(run, "_c.*")
    past = curve.join(cuts, run).where((F.col("rank") > F.col("cut")) & (F.col("total") > min_umis))
    base = past.groupBy(run, "cut_no").agg(F.min(F.col("cum") - F.col("n")).alias("_base"))
    pts = past.join(base, [run, "cut_no"]).withColumn("rank", F.col("rank") - F.col("_base"))
    found = cut_lineage(_knee_and_shin(pts.select(run, "cut_no", "total", "rank"), [run, "cut_no"]))
    top = joins.first_per_group(
        found.groupBy(run, "shin").agg(F.count(F.lit(1)).alias("_n")).withColumn("_name", F.col("shin").cast("string")),
        run, [F.col("_n").desc(), F.col("_name").asc()]).select(run, "shin")
    same = found.join(top, [run, "shin"])
    med = same.groupBy(run).agg(F.median("knee").alias("_med"))
    pick = same.join(med, run).groupBy(run, "shin").agg(
        F.min_by("knee", F.struct(F.abs(F.col("knee") - F.col("_med")), F.col("cut_no"))).alias("knee"))
    best = pick.select(run, F.col("shin").alias("shin2"), F.col("knee").alias("knee2"))
    if given is not None:
        snap = curve.select(run, "total", "rank")
        s = joins.nearest(snap, given, run, "total", "shin2", "rank").select(run, F.col("total").alias("_s"))
        k = joins.nearest(snap, given, run, "total", "knee2", "rank").select(run, F.col("total").alias("_k"))
        best = best.join(s, run, "full").join(k, run, "full").select(
            run, F.coalesce("_s", "shin2").alias("shin2"), F.coalesce("_k", "knee2").alias("knee2"))
    at = curve.select(run, F.col("total").alias("knee2"), F.col("rank").alias("knee2_x"))
    return cut_lineage(best.join(at, [run, "knee2"]))


def droplet_params(curve: DataFrame, knees: DataFrame, low_count: str | int = "shin2", run: str = "run_id") -> DataFrame:
    """Expected cells, droplets to include and the low-count threshold per run.

    ``knees`` holds shin1, shin1_x, knee2, knee2_x, shin2. A numeric threshold must lie below the
    totals at both ranks.
    """
    inc = _log_mean_index(curve, knees, "shin1_x", "knee2_x", "_inc", run)
    out = knees.join(inc, run).withColumns({
        "expected_cells": F.col("shin1_x"), "total_droplets_included": F.round("_inc").cast("long")}).drop("_inc")
    if isinstance(low_count, str):
        return out.withColumn("low_count_threshold", F.col(low_count).cast("long"))
    snap = curve.select(run, "total", "rank")
    e = joins.nearest(snap, out, run, "rank", "expected_cells", "rank").select(run, F.col("total").alias("_e"))
    t = joins.nearest(snap, out, run, "rank", "total_droplets_included", "rank").select(run, F.col("total").alias("_t"))
    ok = (F.lit(low_count) < F.col("_e")) & (F.lit(low_count) < F.col("_t"))
    value = F.when(ok, F.lit(low_count).cast("long")).otherwise(
        F.raise_error(F.lit("low count threshold exceeds the total at expected_cells or total_droplets_included")).cast("long"))
    return out.join(e, run).join(t, run).withColumn("low_count_threshold", value).drop("_e", "_t")


def flag_empty_plateau(ranks: DataFrame, curve: DataFrame, params: DataFrame, run: str = "run_id") -> DataFrame:
    """Add in_empty_plateau: rank from the log-mean start up to the rank of knee2."""
    start = _log_mean_index(curve, params, "shin1_x", "total_droplets_included", "_start", run)
    ends = params.select(run, "knee2_x").join(start, run)
    return ranks.join(ends, run).withColumn(
        "in_empty_plateau", F.col("rank").between(F.col("_start"), F.col("knee2_x"))).drop("_start", "knee2_x")


def barcode_table(totals: DataFrame, lowers: Sequence[int] = FIRST_LOWERS, min_umis: int = MIN_UMIS_EMPTY,
                  low_count: str | int = "shin2", run: str = "run_id") -> DataFrame:
    """Ranks, knees, droplet parameters and plateau flag of every barcode."""
    curve = rank_curve(totals, run)
    k1 = first_knee(curve, lowers, run)
    knees = k1.drop("votes").join(second_knee(curve, k1, min_umis, run=run), run)
    params = cut_lineage(droplet_params(curve, knees, low_count, run))
    ranks = totals.join(curve.select(run, "total", "rank"), [run, "total"])
    cols = [run, "knee1", "shin1", "knee2", "shin2", "expected_cells", "total_droplets_included", "low_count_threshold"]
    return flag_empty_plateau(ranks, curve, params, run).join(params.select(*cols), run)


def call_cells_by_rank(ranks: DataFrame, run: str = "run_id") -> DataFrame:
    """First ``expected_cells`` barcodes of each run; ties in total by barcode."""
    at = ordered.positions(ranks, run, "total", "barcode", "_pos", descending=True)
    return at.where(F.col("_pos") <= F.col("expected_cells")).drop("_pos")


def knee_diagnostics(curve: DataFrame, params: DataFrame, run: str = "run_id", width: float = 0.15) -> DataFrame:
    """Local slopes of log10 total on log10 rank at shin1 and at the included droplets, and their ratios."""
    p = curve.where("total > 5").select(run, F.log10("rank").alias("x"), F.log10("total").alias("y"))
    j = p.join(params.select(run, "shin1_x", "total_droplets_included", "expected_cells"), run)
    near = lambda c: F.abs(F.col("x") - F.log10(c)) <= width
    out = j.groupBy(run, "shin1_x", "total_droplets_included", "expected_cells").agg(
        F.regr_slope(F.when(near("shin1_x"), F.col("y")), F.col("x")).alias("slope_shin1"),
        F.regr_slope(F.when(near("total_droplets_included"), F.col("y")), F.col("x")).alias("slope_total_included"))
    d = F.abs(F.col("slope_shin1"))
    return out.withColumns({
        "slope_ratio": F.abs("slope_total_included") / F.when(d > 0, d),
        "expected_total_ratio": F.col("expected_cells") / F.col("total_droplets_included")}).drop("shin1_x")


def tukey_outliers(df: DataFrame, value: str, by=None) -> DataFrame:
    """Flag values outside the quartiles by more than 1.5 interquartile ranges, on the log10 scale."""
    x = df.withColumn("_v", F.log10(F.when(F.col(value) > 0, F.col(value))))
    keys = ordered.as_list(by)
    gkeys = keys or ["_all"]
    if not keys:
        x = x.withColumn("_all", F.lit(0))
    q = ordered.quantiles(x, gkeys, "_v", {"_q1": 0.25, "_q3": 0.75})
    iqr = F.col("_q3") - F.col("_q1")
    out = (F.col("_v") < F.col("_q1") - 1.5 * iqr) | (F.col("_v") > F.col("_q3") + 1.5 * iqr)
    return x.join(q, gkeys).withColumn("is_outlier", F.coalesce(out, F.lit(False))).select(*df.columns, "is_outlier")


def cells_vs_empties(ranks: DataFrame, run: str = "run_id") -> DataFrame:
    """log10 totals and logit spliced share of called cells and plateau barcodes, long form."""
    x = ranks.where((F.col("rank") <= F.col("expected_cells")) | F.col("in_empty_plateau"))
    what = F.when(F.col("rank") <= F.col("expected_cells"), "cell").otherwise("empty")
    vals = F.array(
        F.struct(F.lit("no. of UMIs").alias("qc_metric"), F.log10("total").alias("qc_val")),
        F.struct(F.lit("spliced pct.").alias("qc_metric"), share_logit(
            F.col("spliced"), F.col("spliced") + F.col("unspliced")).alias("qc_val")))
    return x.select(run, "barcode", what.alias("what"), F.inline(vals))


def parameter_lines(params: DataFrame, run: str = "run_id") -> DataFrame:
    """Knee parameters in long form with the axis they belong to and their kind."""
    names = ["knee1", "shin1", "knee2", "shin2", "total_droplets_included", "expected_cells"]
    long = params.select(run, *[F.col(c).cast("double") for c in names]).unpivot([run], names, "param", "value")
    on_x = F.col("param").isin("total_droplets_included", "expected_cells")
    return long.withColumns({
        "axis": F.when(on_x, "x").otherwise("y"),
        "kind": F.when(on_x, "count").when(F.col("param").startswith("knee"), "knee").otherwise("inflection")})

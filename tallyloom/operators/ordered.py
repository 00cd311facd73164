"""Ranks, running sums, quantiles and adjusted p-values that never gather a group in one task.

Every function first folds equal values together, then splits each group into ordered
pieces by value. Sums of whole pieces (a few rows per group) are scanned once, and the scan
inside a piece runs in parallel with the other pieces. Piece borders come from the exact
minimum and maximum, so a recomputed task sees the same borders; they only steer the balance,
never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import ensure_checkpoint_dir

PIECES = 64  # at least; more when a piece would hold over PIECE_ROWS values
PIECE_ROWS = 100_000
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def as_list(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _finite(value: Column) -> Column:
    """As double, with infinities (and NaN, which sorts last) at the ends of a finite range."""
    return F.greatest(F.lit(-1e300), F.least(F.lit(1e300), value.cast("double")))


def _cut_in_pieces(runs: DataFrame, keys: list[str], value: str, pieces: int) -> DataFrame:
    """Add ``_total`` (rows of the group) and ``_piece`` to a table of (keys, value, n)."""
    span = runs.groupBy(*keys).agg(
        F.min(_finite(F.col(value))).alias("_lo"),
        F.max(_finite(F.col(value))).alias("_hi"),
        F.sum("n").alias("_total"),
        F.greatest(F.lit(pieces), F.ceil(F.count(F.lit(1)) / PIECE_ROWS).cast("int")).alias("_pieces"),
    )
    # relative to the group's smallest value, so that values far from zero spread as well
    away = lambda x: F.log1p(F.greatest(F.lit(0.0), F.least(F.lit(1e300), x - F.col("_lo"))))
    width = away(F.col("_hi"))
    place = away(_finite(F.col(value))) / F.when(width > 0, width)
    piece = F.least(F.floor(F.coalesce(place, F.lit(0.0)) * F.col("_pieces")), F.col("_pieces") - 1).cast("int")
    return runs.join(span, keys).withColumn("_piece", piece).drop("_lo", "_hi", "_pieces")


def running_counts(
    df: DataFrame,
    by: str | Sequence[str] | None,
    value: str,
    *,
    weight: str | None = None,
    descending: bool = False,
    pieces: int = PIECES,
) -> DataFrame:
    """One row per group and distinct value: ``n``, ``cum`` (rows up to and with it), ``group_n``."""
    keys = as_list(by)
    src = df.where(F.col(value).isNotNull())
    n = F.sum(weight) if weight else F.count(F.lit(1))
    if not keys:
        src = src.withColumn("_all", F.lit(0))
    gkeys = keys or ["_all"]
    runs = src.groupBy(*gkeys, value).agg(n.alias("n"))
    cut = _cut_in_pieces(runs, gkeys, value, pieces)
    order = F.col(value).desc() if descending else F.col(value).asc()
    piece_order = F.col("_piece").desc() if descending else F.col("_piece").asc()
    offsets = (
        cut.groupBy(*gkeys, "_piece").agg(F.sum("n").alias("_n"))
        .withColumn("_before", F.coalesce(
            F.sum("_n").over(Window.partitionBy(*gkeys).orderBy(piece_order).rowsBetween(*_BEFORE)), F.lit(0)))
        .drop("_n")
    )
    inner = F.sum("n").over(Window.partitionBy(*gkeys, "_piece").orderBy(order).rowsBetween(*_UP_TO_HERE))
    return (
        cut.withColumn("_inner", inner)
        .join(offsets, [*gkeys, "_piece"])
        .select(*keys, value, "n", (F.col("_before") + F.col("_inner")).alias("cum"), F.col("_total").alias("group_n"))
    )


def mid_rank(
    df: DataFrame,
    by: str | Sequence[str] | None,
    value: str,
    out: str = "rank",
    *,
    descending: bool = True,
    bounded: bool = False,
) -> DataFrame:
    """Add the mean rank of ties; rows with a NULL value get a NULL rank.

    ``bounded=True`` is for groups of known small size (one row per gene of the annotation, per
    cluster, per sample): a plain window then saves two shuffles and a join.
    """
    keys = as_list(by)
    if bounded:
        c = F.col(value)
        whole = Window.partitionBy(*keys)
        ties = F.count(c).over(Window.partitionBy(*keys, value))
        above = F.rank().over(whole.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last()))
        return df.withColumn(out, F.when(c.isNotNull(), (above + (ties - 1) / F.lit(2.0)).cast("double")))
    ranks = running_counts(df, keys, value, descending=descending).select(
        *keys, value, (F.col("cum") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)).cast("double").alias(out)
    )
    return df.join(ranks, [*keys, value], "left").select(*df.columns, out)


def positions(
    df: DataFrame,
    by: str | Sequence[str] | None,
    value: str,
    tie: str,
    out: str = "position",
    *,
    descending: bool = True,
    bounded: bool = False,
) -> DataFrame:
    """Add 1, 2, 3, ... in order of value, then of the tie column; rows without a value drop out.

    ``bounded=True`` uses a plain window (see ``mid_rank``). Otherwise rows are range-partitioned by group,
    value and tie column; each partition numbers its own rows and adds the rows of the group in the
    partitions before it, so a hot group or value is many tasks' work. The ranges are written once, since
    both steps must see the same.
    """
    keys = as_list(by)
    if bounded:
        c = F.col(value)
        w = Window.partitionBy(*keys).orderBy(c.desc() if descending else c.asc(), F.col(tie).asc())
        return df.where(c.isNotNull()).withColumn(out, F.row_number().over(w).cast("long"))
    gkeys = keys or ["_all"]
    src = (df if keys else df.withColumn("_all", F.lit(0))).where(F.col(value).isNotNull())
    order = [F.col(value).desc() if descending else F.col(value).asc(), F.col(tie).asc()]
    ensure_checkpoint_dir(df.sparkSession)
    placed = src.repartitionByRange(*gkeys, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    before = (
        placed.groupBy(*gkeys, "_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per group and partition
        .withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*gkeys).orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0)))
        .drop("_n")
    )
    within = F.row_number().over(Window.partitionBy(*gkeys, "_part").orderBy(*order))
    return (
        placed.withColumn("_within", within).join(before, [*gkeys, "_part"])
        .select(*df.columns, (F.col("_before") + F.col("_within")).cast("long").alias(out))
    )


def quantiles(
    df: DataFrame,
    by: str | Sequence[str] | None,
    value: str,
    probs: Mapping[str, float],
    *,
    weight: str | None = None,
) -> DataFrame:
    """Exact quantiles (linear interpolation between order statistics), one column per name."""
    keys = as_list(by)
    runs = running_counts(df, keys, value, weight=weight)
    aggs: list[Column] = []
    for name, p in probs.items():
        lo = F.floor((F.col("group_n") - 1) * F.lit(float(p)))
        hi = F.least(lo + 1, F.col("group_n") - 1)
        aggs += [
            F.min(F.when(F.col("cum") > lo, F.col(value))).cast("double").alias(f"_{name}_a"),
            F.min(F.when(F.col("cum") > hi, F.col(value))).cast("double").alias(f"_{name}_b"),
        ]
    wide = runs.groupBy(*keys).agg(F.max("group_n").alias("_n"), *aggs)
    cols = []
    for name, p in probs.items():
        at = (F.col("_n") - 1) * F.lit(float(p))
        a, b = F.col(f"_{name}_a"), F.col(f"_{name}_b")
        frac = at - F.floor(at)
        cols.append(F.when(a == b, a).otherwise(a + (b - a) * frac).alias(name))
    return wide.select(*keys, *cols)


def median_by(df: DataFrame, by, value: str, out: str = "median", *, weight: str | None = None) -> DataFrame:
    return quantiles(df, by, value, {out: 0.5}, weight=weight)


def mad_by(df: DataFrame, by, value: str, out: str = "mad", centre: str = "centre", scale: float = 1.4826) -> DataFrame:
    """Median and scaled median absolute deviation per group."""
    keys = as_list(by)
    gkeys = keys or ["_all"]
    src = df if keys else df.withColumn("_all", F.lit(0))
    med = median_by(src, gkeys, value, centre)
    dev = src.join(med, gkeys).withColumn("_dev", F.abs(F.col(value) - F.col(centre)))
    spread = median_by(dev, [*gkeys, centre], "_dev", "_m")
    return spread.select(*keys, centre, (F.col("_m") * scale).alias(out))


def bh_adjust(df: DataFrame, by, p: str = "p_value", out: str = "fdr", *, bounded: bool = False) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values within each group (``bounded``: see ``mid_rank``)."""
    keys = as_list(by)
    if bounded:
        c = F.col(p)
        whole = Window.partitionBy(*keys)
        raw = F.least(F.lit(1.0), c * F.count(c).over(whole) / F.count(c).over(whole.orderBy(c.asc_nulls_last())))
        least = F.min("_raw").over(whole.orderBy(c.desc_nulls_last()))
        return df.withColumn("_raw", raw).withColumn(out, F.when(c.isNotNull(), least)).drop("_raw")
    gkeys = keys or ["_all"]
    src = df if keys else df.withColumn("_all", F.lit(0))
    runs = running_counts(src, gkeys, p).withColumn(
        "_raw", F.least(F.lit(1.0), F.col(p) * F.col("group_n") / F.col("cum")))
    # smallest raw value among equal or larger p-values, piece by piece
    pieces = F.greatest(F.lit(PIECES), F.ceil(F.col("group_n") / PIECE_ROWS))
    cut = runs.withColumn("_piece", F.least(F.floor(F.col("cum") * pieces / F.col("group_n")), pieces - 1).cast("int"))
    later = (
        cut.groupBy(*gkeys, "_piece").agg(F.min("_raw").alias("_m"))
        .withColumn("_later", F.min("_m").over(
            Window.partitionBy(*gkeys).orderBy(F.col("_piece").desc()).rowsBetween(*_BEFORE)))
        .drop("_m")
    )
    here = F.min("_raw").over(Window.partitionBy(*gkeys, "_piece").orderBy(F.col(p).desc()).rowsBetween(*_UP_TO_HERE))
    adjusted = (
        cut.withColumn("_here", here).join(later, [*gkeys, "_piece"])
        .select(*gkeys, p, F.least(F.col("_here"), F.coalesce(F.col("_later"), F.lit(1.0))).alias(out))
    )
    return src.join(adjusted, [*gkeys, p], "left").select(*df.columns, out)

"""Join helpers. Join strategies are left to Catalyst and AQE, which check sizes before they broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.ordered import as_list
from tallyloom.session import cut_lineage


def attach(left: DataFrame, right: DataFrame, on, fill: Mapping[str, object] | None = None) -> DataFrame:
    """Left join that keeps every left row and fills the listed columns where nothing matched."""
    out = left.join(right, on, "left")
    return out.fillna(dict(fill)) if fill else out


def full_outer(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "full")


def keep_in(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    return df.join(ids, on, "left_semi")


def keep_not_in(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    return df.join(ids, on, "left_anti")


def lookup_in_order(ids: DataFrame, table: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``table`` for the ids of the caller, each with the caller's place in ``order``."""
    return ids.select(key, order).join(table, key)


def pair_columns(df: DataFrame, id_cols: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per id and unordered pair of measures (later column first); no join needed."""
    pairs = [
        F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
                 F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        for i, a in enumerate(measures) for b in measures[:i]
    ]
    return df.select(*id_cols, F.inline(F.array(*pairs)))


def pair_rows(df: DataFrame, by, order: str, value: str) -> DataFrame:
    """Pairs (i > j) of rows of the same small group, e.g. the tags of one cell.

    A group holds one row per tag, so its array is bounded by the number of tags.
    """
    keys = as_list(by)
    items = F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), F.col(value).alias("v"))))
    grouped = df.groupBy(*keys).agg(items.alias("_items"))
    first = grouped.select(*keys, "_items", F.posexplode("_items").alias("_i", "_a"))
    second = first.select(*keys, "_a", F.explode(F.slice(F.col("_items"), F.lit(1), F.col("_i"))).alias("_b"))
    return second.select(
        *keys,
        F.col("_a.k").alias(f"{order}_x"), F.col("_b.k").alias(f"{order}_y"),
        F.col("_a.v").alias("x"), F.col("_b.v").alias("y"))


def complete(df: DataFrame, rows: Sequence[str], cols: Sequence[str], fill: Mapping[str, object],
             row_values: DataFrame | None = None) -> DataFrame:
    """Add the missing (rows, cols) combinations with fill values.

    The result has a row for each pair by definition. Column keys (one per sample) are numbered in a small written table;
    each row key gathers its own numbers, at most one per sample, and adds those it lacks where it stands, so the
    filled table is never sent anywhere.
    """
    values = [c for c in df.columns if c not in (*rows, *cols)]
    listed = df.select(*cols).distinct().agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("_k"))
    names = cut_lineage(listed.select(F.posexplode("_k").alias("_i", "_c")).select("_i", "_c.*"))
    n = names.count()
    if not n:
        return df.select(*rows, *cols, *values).where("false")
    known = reduce(and_, [F.col(c).isNotNull() for c in ("_i", *rows)])  # a null key meets nothing
    own = df.join(names, list(cols), "left").groupBy(*rows).agg(F.collect_list(F.when(known, F.struct("_i", *values))).alias("_own"))
    if row_values is not None:
        own = row_values.select(*rows).distinct().join(own, list(rows), "left")
    empty = F.array().cast(own.schema["_own"].dataType)
    own = own.withColumn("_own", F.coalesce("_own", empty))
    lacking = F.array_except(F.sequence(F.lit(0), F.lit(n - 1)), F.col("_own._i"))
    blank = F.transform(lacking, lambda i: F.struct(i.alias("_i"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in values]))
    every = own.select(*rows, F.explode(F.concat("_own", blank)).alias("_e")).select(*rows, "_e.*")
    return every.join(names, "_i").select(*rows, *cols, *values).fillna(dict(fill))


def within_interval(values: DataFrame, bounds: DataFrame, on, value: str, lo: str, hi: str) -> DataFrame:
    """Rows whose value lies in the inclusive interval of their group; missing ends are open."""
    inside = (F.col(lo).isNull() | (F.col(value) >= F.col(lo))) & (F.col(hi).isNull() | (F.col(value) <= F.col(hi)))
    return values.join(bounds, on).where(inside)


def nearest(points: DataFrame, targets: DataFrame, on, value: str, target: str, tie: str) -> DataFrame:
    """For each target the row of the same group with the closest value; first by ``tie`` when equal.

    The minimum is a plain aggregate, so it is combined before the shuffle.
    """
    keys = as_list(on)
    others = [c for c in points.columns if c not in keys]
    row = F.struct(*others)
    best = F.min_by(row, F.struct(F.abs(F.col(value) - F.col(target)), F.col(tie)))
    return (
        points.join(targets.select(*keys, target), keys)
        .groupBy(*keys, target).agg(best.alias("_r")).select(*keys, target, "_r.*")
    )


def translate_ids(df: DataFrame, dictionary: DataFrame, key: str, new_key: str) -> DataFrame:
    """Replace ids by their partner in a dictionary; ids without partner are dropped."""
    pairs = dictionary.select(F.col(key), F.col(new_key))
    return df.join(pairs, key).drop(key).withColumnRenamed(new_key, key)


def contained_ids(df: DataFrame, col: str, grams: int = 3) -> DataFrame:
    """Pairs of ids where one is a substring of the other.

    Candidates share the leading characters of the shorter id at some offset of the longer
    one (an equi join), then ``contains`` settles it.
    """
    ids = df.select(F.col(col).alias("id")).distinct().where(F.length("id") > 0)
    short = ids.select(F.col("id").alias("inner_id"), F.substring("id", 1, grams).alias("_g"))
    offsets = F.sequence(F.lit(1), F.length("id"))
    windows = F.array_distinct(F.flatten(F.transform(
        offsets, lambda i: F.transform(F.sequence(F.lit(1), F.lit(grams)), lambda n: F.substring(F.col("id"), i, n)))))
    long = ids.select(F.col("id").alias("outer_id"), F.explode(windows).alias("_g"))
    return (
        short.join(long, "_g")
        .where((F.col("inner_id") != F.col("outer_id")) & F.contains(F.col("outer_id"), F.col("inner_id")))
        .select("inner_id", "outer_id").distinct()
    )


def membership_flag(df: DataFrame, pairs: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    """TRUE where the key is among the valid pairs; all rows stay."""
    valid = pairs.select(*on).distinct().withColumn("_hit", F.lit(True))
    return df.join(valid, list(on), "left").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_hit")


def marker_lookup(custom: DataFrame, genes: DataFrame, variances: DataFrame) -> DataFrame:
    """Custom markers with symbol (via ``ensembl_id`` if absent) and the most variable gene_id per symbol."""
    if "symbol" not in custom.columns:
        custom = custom.join(genes.select("ensembl_id", "symbol"), "ensembl_id", "left")
    best = variances.groupBy("symbol").agg(
        F.max_by("gene_id", F.struct(F.col("vst_var"), F.col("gene_id"))).alias("gene_id"))
    return custom.join(best, "symbol")


def assign_external(cells: DataFrame, assignment: DataFrame, metadata: DataFrame) -> DataFrame:
    """Attach a supplied cell -> sample table and sample metadata; derive ``demux_class``.

    A ``class`` column of the supplied table is used where it is present.
    """
    src = assignment if "class" in assignment.columns else assignment.withColumn("class", F.lit(None).cast("string"))
    joined = cells.join(src.select("pool_id", "cell_id", "sample_id", "class"), ["pool_id", "cell_id"], "left")
    joined = joined.join(metadata, ["pool_id", "sample_id"], "left")
    derived = F.when(F.col("sample_id").isNotNull(), "singlet").otherwise("negative")
    return joined.withColumn("demux_class", F.coalesce("class", derived)).drop("class")


def first_per_group(df: DataFrame, by, order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """First n rows per group. Spark limits each group inside the map tasks before it shuffles."""
    keys = as_list(by)
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank) if rank else out.drop("_rn")

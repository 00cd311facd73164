"""Approximate nearest neighbours by neighbour descent: neighbours of neighbours, round after round."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.embed import N_NEIGHBOURS, _merge, _search
from tallyloom.session import cut_lineage

LEAF_SAMPLE = 10  # sampled cells per leaf of a projection tree, at least
TILE = 64  # cells whose candidates are compared at once


def _tree(x: np.ndarray, n: int, block_rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A direction per level and the median of each node, from a sample."""
    depth = int(max(0, min(np.ceil(np.log2(max(1, n / block_rows))), np.log2(max(1, len(x) / LEAF_SAMPLE)))))
    ways = np.random.default_rng(seed).normal(size=(x.shape[1], depth))
    at, cuts, node = x @ ways, np.zeros(2**depth - 1), np.zeros(len(x), int)
    for level in range(depth):
        for i in range(2**level - 1, 2 ** (level + 1) - 1):
            here = at[node == i, level]
            cuts[i] = np.median(here) if len(here) else 0.0
        node = 2 * node + 1 + (at[:, level] > cuts[node])
    return ways, cuts


def _compare(links: pd.DataFrame, cells: pd.DataFrame, k: int) -> pd.DataFrame:
    """Pairs of cells linked to a common one, at least one link fresh, that are nearer than one side's k-th neighbour."""
    none = pd.DataFrame({"cell_id": [], "neighbour": [], "distance": []})
    if len(links) == 0 or len(cells) == 0:
        return none
    cells = cells.sort_values("_other", ignore_index=True)
    ids, x, bound = cells["_other"].to_numpy(), np.stack(cells["_embedding"].to_numpy()), cells["_bound"].to_numpy()
    square = (x**2).sum(1)
    links = links.sort_values(["cell_id", "other"], ignore_index=True)
    row = pd.factorize(links["cell_id"])[0]
    col = np.arange(len(row)) - np.searchsorted(row, row)
    who = np.full((row[-1] + 1, col.max() + 1), -1)
    fresh = np.zeros(who.shape, bool)
    who[row, col], fresh[row, col] = np.searchsorted(ids, links["other"].to_numpy()), links["fresh"].to_numpy()
    pairs: list[np.ndarray] = []
    for i in range(0, len(who), TILE):
        w, f = who[i : i + TILE], fresh[i : i + TILE]
        v = x[w]
        d2 = square[w][:, :, None] + square[w][:, None, :] - 2 * v @ v.transpose(0, 2, 1)
        some = (w[:, :, None] >= 0) & (w[:, None, :] >= 0) & (f[:, :, None] | f[:, None, :]) & (w[:, :, None] != w[:, None, :])
        t, a, b = np.nonzero(some & (d2 <= (bound[w] ** 2 * (1 + 1e-9) + 1e-12)[:, :, None]))
        pairs.append(np.unique(w[t, a] * len(ids) + w[t, b]))
    key = np.unique(np.concatenate(pairs))
    if not len(key):
        return none
    a, b = key // len(ids), key % len(ids)
    dist = np.zeros(len(key))
    for j in range(x.shape[1]):  # exact differences, one dimension at a time
        dist += (x[a, j] - x[b, j]) ** 2
    dist = np.sqrt(dist)
    order = np.lexsort((b, dist, a))
    a, b, dist = a[order], b[order], dist[order]
    first = np.arange(len(a)) - np.searchsorted(a, a) < k  # others can't be among the k best
    return pd.DataFrame({"cell_id": ids[a[first]], "neighbour": ids[b[first]], "distance": dist[first]})


def knn_descent(emb: DataFrame, k: int = N_NEIGHBOURS, *, n_trees: int = 3, block_rows: int = 1000, least_change: float = 0.001,
                sample: int = 20_000, seed: int = 42) -> DataFrame:
    """About the k nearest neighbours (Euclidean, the cell itself excluded): cell_id, neighbour, distance, rank.

    The start is the best of ``n_trees`` random projection trees, whose leaves are searched in blocks of about
    ``block_rows`` cells (a larger leaf is dealt over blocks by a hash). A round compares, for every
    cell, its neighbours and k of the cells that have it as neighbour, where one of the two links is new since the last
    round, and keeps each cell's best k. Rounds go on until fewer than ``least_change`` of all links change.
    Work and shuffles of a round are in proportion to cells times k: a block of cells gets each vector it needs once,
    and only pairs that improve a list leave it. Distances are exact; ``embed.knn`` is the exact way.

    Cells without a vector take no part; ``cell_id`` must be distinct; a table of k cells or fewer gives all pairs.
    """
    kind = dict(emb.dtypes)["cell_id"]
    src = emb.where("embedding IS NOT NULL AND cell_id IS NOT NULL").select("cell_id", F.col("embedding").cast("array<double>").alias("embedding"))
    spark, n = emb.sparkSession, src.count()
    out = f"cell_id {kind}, neighbour {kind}, distance double"
    if n == 0:
        return spark.createDataFrame([], out + ", rank int")
    part = src.where(F.pmod(F.xxhash64("cell_id", F.lit(seed)), F.lit(1 << 20)) <= min(1.0, sample / n) * (1 << 20))
    x = part.toPandas().sort_values("cell_id")["embedding"]  # about ``sample`` cells
    x = np.stack(x.to_numpy()) if len(x) else np.stack(src.limit(1).toPandas()["embedding"].to_numpy())
    trees = spark.sparkContext.broadcast([_tree(x, n, block_rows, seed + t) for t in range(n_trees)])

    def place(batches):
        for pdf in batches:
            if len(pdf):
                v, leaves = np.stack(pdf["embedding"].to_numpy()), []
                for ways, cuts in trees.value:
                    at, node = v @ ways, np.zeros(len(v), int)
                    for level in range(ways.shape[1]):
                        node = 2 * node + 1 + (at[:, level] > cuts[node])
                    leaves.append(node)
                yield pdf.assign(leaves=list(np.stack(leaves, 1)))

    placed = src.mapInPandas(place, f"cell_id {kind}, embedding array<double>, leaves array<int>")
    trees_of = placed.select("cell_id", "embedding", F.posexplode("leaves").alias("region", "leaf"))
    sizes = trees_of.groupBy("region", "leaf").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("_many"))  # a row per leaf
    block = F.pmod(F.xxhash64("cell_id", "region"), F.col("_many")).cast("int")
    pts = cut_lineage(trees_of.join(sizes, ["region", "leaf"]).select(
        "cell_id", "embedding", "region", F.concat_ws("-", "leaf", block).alias("block"), F.lit("").alias("grp")))
    own = pts.withColumns({"q_region": F.col("region"), "q_block": F.col("block")})
    graph = cut_lineage(_merge(_search(own, pts, k).distinct(), k).withColumn("fresh", F.lit(True)))
    home = pts.where("region = 0").select("cell_id", "embedding", "block")
    turn = 0
    while graph.where("fresh").count() > (least_change * n * k if turn else 0):
        bound = graph.groupBy("cell_id").agg(F.max("rank").alias("_r"), F.max("distance").alias("_d"))
        full = home.join(bound, "cell_id", "left").select(
            F.col("cell_id").alias("other"), "embedding", F.when(F.col("_r") == k, F.col("_d")).otherwise(float("inf")).alias("bound"))
        # a cell that many have as neighbour: the k first by a hash, cut before the shuffle
        pick = Window.partitionBy("cell_id").orderBy(F.xxhash64("other", F.lit(seed + turn)), "other")
        back = graph.select(F.col("neighbour").alias("cell_id"), F.col("cell_id").alias("other"), "fresh")
        back = back.withColumn("_n", F.row_number().over(pick)).where(F.col("_n") <= k).drop("_n")
        links = graph.select("cell_id", F.col("neighbour").alias("other"), "fresh").unionByName(back)
        links = links.groupBy("cell_id", "other").agg(F.max("fresh").alias("fresh")).join(home.select("cell_id", "block"), "cell_id")
        links = cut_lineage(links.select("block", "cell_id", "other", "fresh"))
        needed = links.select("block", "other").distinct().join(full, "other").select("block", "other", "embedding", "bound")
        needed = needed.toDF("_block", "_other", "_embedding", "_bound")
        near = links.groupBy("block").cogroup(needed.groupBy("_block")).applyInPandas(lambda a, b: _compare(a, b, k), out)
        both = graph.select("cell_id", "neighbour", "distance", F.lit(False).alias("fresh")).unionByName(near.withColumn("fresh", F.lit(True)))
        both = both.groupBy("cell_id", "neighbour").agg(F.min("distance").alias("distance"), F.min("fresh").alias("fresh"))
        rank = F.row_number().over(Window.partitionBy("cell_id").orderBy("distance", "neighbour"))
        graph = cut_lineage(both.withColumn("rank", rank).where(F.col("rank") <= k))
        turn += 1
    return graph.select("cell_id", "neighbour", "distance", "rank")

"""Nearest vectors by inverted lists and an adaptive scan over dimensions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BLOCK = 2048  # vectors of a list that are scanned together
QUERY_BLOCK = 256
ASK_ROWS = 16_384  # queries and lists that a task pairs
PAIRS = 1 << 16  # pairs of a query and a vector that a task holds at once
VALUES = "list int, block int, ids binary, original binary"


@dataclass
class Index:
    """Rotation, centres of the lists (rotated), and how many vectors each list has."""

    rotation: np.ndarray
    centres: np.ndarray
    probe: float  # share of the lists that a query probes
    sizes: np.ndarray | None = None


def usable(df: DataFrame, id_col: str, vector: str, dim: int) -> DataFrame:
    """Rows with an id and a vector of ``dim`` finite components that are not all zero."""
    v = F.col(vector)
    good = (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("v"))


def matrix(col, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest_lists(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances to the centres, up to what is the same for all of them."""
    return (centres**2).sum(1) - 2 * x @ centres.T


def fit(vectors: DataFrame, n: int, dim: int, sample: int = 40_000, k: int = 10, recall: float = 0.97, rounds: int = 8, seed: int = 7) -> Index:
    """Rotation by a random orthogonal matrix and k-means centres, fitted on about ``sample`` rows by a hash
    of the id. The number of lists grows as the square root of the rows, to a sixteenth of the sample.
    The share of lists to probe is that which holds ``recall`` of the sample's own nearest neighbours."""
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    part = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < min(1.0, sample / max(1, n)) * (1 << 30))
    got = part.orderBy("vec_id").select("v").toArrow().column(0)  # bounded by ``sample``
    x = matrix(got, dim) @ rotation if len(got) else np.zeros((1, dim))
    n_lists = int(max(1, min(n**0.5, sample / 16, len(x))))
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.choice(len(distinct), min(n_lists, len(distinct)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([nearest_lists(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        count = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, x[:, j], len(centres)) for j in range(dim)], 1)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    own = np.concatenate([nearest_lists(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
    places = []
    for q in rng.choice(len(x), min(300, len(x)), replace=False):
        near = np.argsort(((x - x[q]) ** 2).sum(1), kind="stable")
        near = near[near != q][:k]
        order = np.argsort(np.argsort(nearest_lists(x[q : q + 1], centres)[0], kind="stable"))
        places.append(order[own[near]] + 1)
    places = np.concatenate(places)
    return Index(rotation, centres, float(np.quantile(places, recall, method="higher") / len(centres)) if len(places) else 1.0)


def adaptive_scan(q: np.ndarray, rotated: np.ndarray, k: int, step: int, epsilon: float, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) whose distance may be among the query's ``k`` smallest, but for those in ``skip``.

    Dimensions are read in column blocks, the first one for all pairs at once. After d of D of them the scaled partial distance is
    tested against the k-th smallest known: a candidate goes when partial > bound * d / D * (1 + epsilon / sqrt(d))**2,
    which for a random rotation rejects a nearer vector only with a small probability.
    """
    dim = q.shape[1]
    norms = (q**2).sum(1)[:, None], (rotated**2).sum(1)
    slack = (dim + 8) * 4e-15 * (norms[0][:, 0] + norms[1].max(initial=0.0))  # of the products of matrices

    def squares(rows: int, upto: int) -> np.ndarray:
        a, b = q[:, :upto], rotated[:rows, :upto]
        d = (a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T
        return np.where(np.isnan(d), 0.0, d)  # beyond doubles: not known, so not rejected

    # the first rows give a bound to start from
    head = np.where(skip[:, : 4 * k], np.inf, squares(4 * k, dim))
    bound = (np.partition(head, k - 1, axis=1)[:, k - 1] if head.shape[1] >= k else np.full(len(q), np.inf)) + slack
    bound = np.where(np.isfinite(norms[0][:, 0] + norms[1].max(initial=0.0)), bound, np.inf)

    def most(seen: int) -> np.ndarray:
        return bound * (seen / dim) * (1 + (epsilon / np.sqrt(seen) if seen < dim else 1e-9)) ** 2 + slack

    partial = squares(len(rotated), min(step, dim))
    rows, cols = np.nonzero((partial <= most(min(step, dim))[:, None]) & ~skip)
    partial = partial[rows, cols]
    for d in range(step, dim, step):
        gap = rotated[cols, d : d + step] - q[rows, d : d + step]
        partial += np.einsum("ij,ij->i", gap, gap)
        keep = partial <= most(min(d + step, dim))[rows]
        rows, cols, partial = rows[keep], cols[keep], partial[keep]
    return rows, cols


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dim: int | None = None, k: int = 10, recall: float = 0.97,
           step: int = 16, epsilon: float = 2.1, sample: int = 40_000) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for each row of ``queries`` (Euclidean, never the row itself).

    Every row goes to the list of its nearest centre; a list is stored in blocks, so a hot list is many
    tasks' work. A query probes its nearest lists: the share that the sample needs for ``recall``, and more until they
    hold enough rows. Each block gives its ``k`` best by the adaptive scan, distances of these on the original
    vectors in double precision, and the best of all blocks are the result.

    Columns: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id. Rows whose vector is
    null, zero, of another length than ``dim`` (default: the commonest), or has null, NaN or infinite
    components, and rows with a null id, take no part, as queries neither. Repeated ids are one row of the
    id each. An empty table gives no rows; other columns are not read.
    """
    if dim is None:
        common = vectors.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
        dim = common["d"] if common and common["d"] > 0 else 1
    rows = usable(vectors, id_col, vector, dim)
    n = rows.count()
    index = fit(rows, n, dim, sample, k, recall)
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(index)  # bounded by the sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            x = matrix(batch.column(1), dim)
            for i in range(0, len(x), 4096):
                part = x[i : i + 4096] @ ix.rotation
                own = nearest_lists(part, ix.centres).argmin(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 4096), pa.array(own), pa.array(list(x[i : i + 4096]))], ["vec_id", "list", "v"])

    placed = rows.mapInArrow(assign, "vec_id long, list int, v array<double>")
    sizes = placed.groupBy("list").count().collect()  # a row per list
    index.sizes = np.zeros(len(index.centres), np.int64)
    for r in sizes:
        index.sizes[r["list"]] = r["count"]
    full = spark.sparkContext.broadcast(index)

    n_blocks = F.element_at(F.array(*[F.lit(int(-(-s // BLOCK)) or 1) for s in index.sizes]), F.col("list") + 1)
    blocks = placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int"))

    def store(t: pa.Table) -> pa.Table:
        t = t.sort_by("vec_id")
        x = matrix(t.column("v"), dim)
        return pa.table({"list": t.column("list")[:1], "block": t.column("block")[:1], "ids": pa.array([t.column("vec_id").to_numpy().tobytes()], pa.binary()),
                         "original": pa.array([x.tobytes()], pa.binary())})

    stored = blocks.groupBy("list", "block").applyInArrow(store, VALUES)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = full.value
        least = max(1, int(np.ceil(ix.probe * len(ix.centres))))
        for batch in batches:
            x = matrix(batch.column(1), dim)
            order = np.argsort(nearest_lists(x @ ix.rotation, ix.centres), axis=1, kind="stable")
            have = np.cumsum(ix.sizes[order], axis=1)
            # the list that brings the rows to k and the query itself is needed too
            need = np.maximum(least, 1 + (have < 4 * k + 1).sum(1))
            q = np.repeat(np.arange(len(x)), np.minimum(need, len(ix.centres)))
            lists = np.concatenate([order[i, :m] for i, m in enumerate(need)]) if len(x) else np.zeros(0, np.int64)
            ids = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(lists.astype(np.int32)), batch.column(1).take(pa.array(q))], ["query_id", "list", "q"])

    n_queries = queries.count()
    tasks = 1 + int(n_queries * index.probe * len(index.centres)) // ASK_ROWS  # a few bytes of queries become many rows
    asked = usable(queries, id_col, vector, dim).repartition(tasks, "vec_id").dropDuplicates(["vec_id"]).mapInArrow(probes, "query_id long, list int, q array<double>")
    # the queries of a list in blocks as well: about QUERY_BLOCK if the list is as hot as an average one
    per_list = max(1, int(n_queries * index.probe) // QUERY_BLOCK)
    grouped = asked.groupBy("list", F.pmod(F.xxhash64("query_id"), F.lit(per_list)).alias("qb")).agg(F.collect_list(F.struct("query_id", "q")).alias("asked"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query_id, vec_id, score = [], [], []
            for ids, original, asked_ in zip(*(batch.column(c) for c in ("ids", "original", "asked"))):
                own = np.frombuffer(ids.as_buffer(), np.int64)
                x = np.frombuffer(original.as_buffer(), np.float64).reshape(-1, dim)
                r = x @ full.value.rotation
                asker, q = asked_.values.flatten()
                asker, q = asker.to_numpy(), matrix(q, dim)
                for i in range(0, len(q), many := max(1, PAIRS // len(x))):
                    t = slice(i, i + many)
                    rows, at = adaptive_scan(q[t] @ full.value.rotation, r, k, step, epsilon, asker[t, None] == own)
                    d = np.sqrt(((x[at] - q[t][rows]) ** 2).sum(1))
                    order = np.lexsort((own[at], d, rows))
                    rows, at, d = rows[order], at[order], d[order]
                    best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
                    query_id += asker[t][rows[best]].tolist()
                    vec_id += own[at[best]].tolist()
                    score += d[best].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(query_id, pa.int64()), pa.array(vec_id, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"])

    # the queries grow with their lists, which Spark does not see from their own few bytes: it would send all of them through the driver
    found = stored.join(grouped.hint("merge"), "list").select("ids", "original", "asked").mapInArrow(scan, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Hard negatives: Strassen products of integer vector tiles, best positives per anchor, best negatives per score window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

SCALE = 256
TOTAL = 1 << 56  # products stay below, so that 100 times one fits a long
LEAF = 16
ANCHOR_TILE, TILE = 512, 1024  # rows
TILE_CELLS = 1 << 20  # numbers in a tile of long vectors
ANCHORS, CANDIDATES = 1 << 14, 1 << 17  # rows that meet in one group at most
LEAST = 2048
NONE = np.iinfo(np.int64).min
BLOCK = "ids binary, labels binary, vectors binary, scores binary, counts binary, positives binary, width int"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two int64 matrices by seven half-size products a level; odd sides are padded with zeros.

    Additions and products wrap modulo 2**64, so the result is exact whenever it fits int64, whatever the
    size of the sums in between.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, b.shape[1] // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    b11, b12, b21, b22 = b[:h, :j], b[:h, j:], b[h:, :j], b[h:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The ``k`` best (score, smaller id first) of each row; heaps of parts of the data merge to those of the whole."""

    def __init__(self, n_rows: int, k: int):
        self.k = k
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(n_rows, NONE + 1)  # a lower score can't enter

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = np.append(self.row, row), np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = order[place < self.k]
        self.row, self.score, self.id = row[place < self.k], score[kept], ids[kept]
        self.floor[row[place == self.k - 1]] = score[order[place == self.k - 1]]

    def add_tile(self, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Offer a tile (rows x candidates); ``fits`` marks what may enter, ``rows`` names its rows."""
        x = np.where(fits, scores, NONE)
        some = np.flatnonzero((x >= self.floor[rows][:, None]).any(1))
        if not len(some):
            return
        x, rows = x[some], rows[some]
        bound = self.floor[rows]
        if x.shape[1] > self.k:
            bound = np.maximum(bound, np.partition(x, -self.k, axis=1)[:, -self.k])
        r, c = np.nonzero(x >= bound[:, None])
        self.add(rows[r], x[r, c], ids[c])


def usable(rows: DataFrame, id_col: str, label: str, vector: str) -> DataFrame:
    """vec_id, label and v of the rows that take part (see ``mine``)."""
    v = F.col("v")
    most = F.sqrt(F.lit(float(TOTAL)) / F.greatest(F.size(v), F.lit(1))) - 1
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(F.forall(v, lambda x: x.isNotNull() & (F.abs(x * SCALE) <= most)))


def tiles(rows: DataFrame, n_rows: int) -> DataFrame:
    """Vectors, floored after scaling, as int64 tiles of at most ``n_rows`` rows of one length, with what goes along with each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            offs, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)
            size = np.diff(offs)
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            extra = [[np.array(x if x is not None else [], np.int64) for x in batch.column(i).to_pylist()] for i in range(3, batch.num_columns)]
            for width in np.unique(size):
                own = np.flatnonzero(size == width)
                step = int(max(1, min(n_rows, TILE_CELLS // max(1, width))))
                for at in (own[i : i + step] for i in range(0, len(own), step)):
                    x = np.floor(SCALE * flat[offs[at][:, None] + np.arange(width)]).astype(np.int64)
                    more = [np.stack([e[i] for i in at]).tobytes() for e in extra] or [None] * 3
                    yield pa.RecordBatch.from_arrays([*[pa.array([b], pa.binary()) for b in (ids[at].tobytes(), labels[at].tobytes(), x.tobytes(), *more)], pa.array([width], pa.int32())],
                                                     ["ids", "labels", "vectors", "scores", "counts", "positives", "width"])

    return rows.mapInArrow(run, BLOCK)


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["width"])


def _meet(anchors: DataFrame, candidates: DataFrame, n_anchor_groups: int, n_groups: int, judge, schema: str) -> DataFrame:
    """Every tile of anchors meets every tile of candidates in one group, whose size is bounded."""
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("ids", "width"), F.lit(n)).cast("int")
    a = anchors.select("*", F.lit(True).alias("anchor"), own(n_anchor_groups).alias("h")).select("*", spread(n_groups).alias("g"))
    c = candidates.select("*", F.lit(False).alias("anchor"), own(n_groups).alias("g")).select("*", spread(n_anchor_groups).alias("h"))

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        return judge([r for r in rows if r["anchor"]], [_open(r) for r in rows if not r["anchor"]])

    return a.unionByName(c).groupBy("h", "g").applyInArrow(run, schema)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b; the shorter vectors count as padded with zeros."""
    width = min(a.shape[1], b.shape[1])
    return strassen(np.ascontiguousarray(a[:, :width]), np.ascontiguousarray(b[:, :width].T))


def mine(vectors: DataFrame, anchors: DataFrame, id_col: str = "vec_id", label: str = "label", vector: str = "embedding", n_positives: int = 5, n_negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """Negatives for each anchor and each of its best positives whose scores lie in a window below the positive's.

    Components become floor(256 x); a score is the integer inner product with the anchor. An anchor's positives are the
    ``n_positives`` best rows of its label with another id; its negatives for one of them are the
    ``n_negatives`` best rows of other labels with low * positive <= 100 * score <= high * positive. Higher scores come
    first, then smaller ids. All anchors are multiplied with all rows, tile by tile, once for the positives and
    once for the windows; each group of tiles hands on its heaps, which merge.

    Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. Rows with a
    null id, label or vector, with a null, NaN or infinite component, or with one so large that a product might not
    fit (for 64 components: beyond some 10**5) take no part; shorter vectors count as padded with zeros. Rows that
    share an anchor's id are not its positives or negatives; of several anchors with one id the smallest
    (label, vector) is taken; repeated rows count one each. Labels are integers. No usable anchor or row: no rows.
    Other columns are not read.
    """
    rows = usable(vectors, id_col, label, vector)
    asked = usable(anchors, id_col, label, vector).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.label", "x.v")
    asked = cut_lineage(asked)
    n_rows, n_asked = rows.count(), asked.count()
    n_groups = max(1, -(-n_rows // min(CANDIDATES, max(LEAST, n_rows // 24))))
    n_anchor_groups = max(1, -(-n_asked // ANCHORS))
    stored = tiles(rows, TILE)

    def positives(left: list[dict], right: list) -> pa.Table:
        out = []
        for row in left:
            ids, labels, x = _open(row)
            heaps = Heaps(len(ids), n_positives)
            for ids2, labels2, y in right:
                if np.isin(labels2, labels).any():
                    fits = (labels[:, None] == labels2) & (ids[:, None] != ids2)
                    heaps.add_tile(product(x, y), fits, ids2, np.arange(len(ids)))
            out.append(pa.table({"anchor_id": ids[heaps.row], "positive_id": heaps.id, "score": heaps.score}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], pa.int64()) for c in ("anchor_id", "positive_id", "score")})

    best = W.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    found = _meet(tiles(asked, ANCHOR_TILE), stored, n_anchor_groups, n_groups, positives, "anchor_id long, positive_id long, score long")
    top = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= n_positives)
    each = top.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("n", "positive_id", "score"))).alias("p"))  # n_positives at most
    at = lambda field: F.transform(F.sequence(F.lit(0), F.lit(n_positives - 1)), lambda i: F.coalesce(F.get(F.col("p"), i)[field], F.lit(0)))
    aimed = cut_lineage(asked.join(each, asked["vec_id"] == each["anchor_id"]).select(
        "vec_id", "label", "v", at("score").alias("scores"), F.array(F.size("p")).alias("n"), at("positive_id").alias("positives")))

    def windows(left: list[dict], right: list) -> pa.Table:
        out = []
        for row in left:
            ids, labels, x = _open(row)
            scores, many, pos = (np.frombuffer(row[c], np.int64).reshape(len(ids), -1) for c in ("scores", "counts", "positives"))
            lowest, highest = -(-low * scores // 100), high * scores // 100
            heaps = Heaps(len(ids) * n_positives, n_negatives)
            for ids2, labels2, y in right:
                other = (labels[:, None] != labels2) & (ids[:, None] != ids2)
                if other.any():
                    s = product(x, y)
                    for j in range(n_positives):
                        fits = other & (s >= lowest[:, j, None]) & (s <= highest[:, j, None]) & (j < many)
                        heaps.add_tile(s, fits, ids2, np.arange(len(ids)) * n_positives + j)
            a, j = heaps.row // n_positives, heaps.row % n_positives
            out.append(pa.table({"anchor_id": ids[a], "n": j, "positive_id": pos[a, j], "positive_score": scores[a, j], "negative_id": heaps.id, "negative_score": heaps.score}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], pa.int64()) for c in ("anchor_id", "n", "positive_id", "positive_score", "negative_id", "negative_score")})

    hard = _meet(tiles(aimed, ANCHOR_TILE), stored, n_anchor_groups, n_groups, windows,
                 "anchor_id long, n long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = W.partitionBy("anchor_id", "n").orderBy(F.desc("negative_score"), "negative_id")
    return hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

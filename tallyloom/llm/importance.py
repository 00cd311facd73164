"""Importance resampling towards a target text: exact totals of hashed word features, gains per bucket, Gumbel draws.

A feature is a word or a pair of neighbouring words, its bucket the CRC-32 of its bytes modulo the number of
buckets. Frequent words and pairs are looked up in tables of fixed size that hold their CRC states and buckets;
all others run through the CRC byte by byte. What the tables hold only saves work: buckets are the same without them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A
from tallyloom.operators.ordered import positions
from tallyloom.session import cut_lineage

U64 = np.uint64
N_BUCKETS = 10_000
SLICE = 2 << 20
WORD_SLOTS, PAIR_SLOTS = 1 << 16, 1 << 18  # of the head tables, which bounds what is broadcast (5 MB)
HEAD_WORDS, HEAD_PAIRS = 1 << 15, 1 << 17
SEEN = 4  # a word or pair so often in a slice may be frequent
PACKED = 16  # bytes of a word that the two integers of its key hold
STEPS = 64  # longer words run through zlib one by one
_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> np.uint32(1) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _byte_table()


def crc_run(buf: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray | int = 0) -> np.ndarray:
    """CRC-32 of each byte range, going on from ``state`` (the CRC of what comes before it)."""
    size = end - start
    out = np.empty(len(start), np.uint32)
    state = np.broadcast_to(np.asarray(state, np.uint32), len(start))
    for i in np.flatnonzero(size > STEPS).tolist():
        out[i] = zlib.crc32(buf[start[i] : end[i]], int(state[i]))
    order = np.flatnonzero(size <= STEPS)
    order = order[np.argsort(size[order].astype(np.uint8), kind="stable")[::-1]]
    length, at = size[order], start[order]
    crc = ~state[order]
    live = np.searchsorted(-length, -np.arange(1, STEPS + 1), "right")  # ranges with more than i bytes
    for i in range(STEPS):
        m = live[i]
        if m == 0:
            break
        c = crc[:m]
        crc[:m] = _CRC[(c ^ buf[at[:m] + i]) & np.uint32(255)] ^ c >> np.uint32(8)
    out[order] = ~crc
    return out


def spaced(crc: np.ndarray) -> np.ndarray:
    """CRC after one more byte, a space."""
    c = ~crc
    return ~(_CRC[(c ^ np.uint32(32)) & np.uint32(255)] ^ c >> np.uint32(8))


@dataclass
class Slice:
    """Words of a slice: lower-cased bytes, ranges, row offsets, and the bytes of short words as two integers."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    offs: np.ndarray
    low: np.ndarray
    high: np.ndarray


def words(col) -> Slice:
    raw, offs = A.column_bytes(col)
    buf = np.zeros(len(raw) + PACKED, np.uint8)
    buf[: len(raw)] = A.ascii_lower(raw)
    start, end, row_offs = A.word_ranges(raw, offs, _GAP)
    size = end - start
    eight = np.ndarray(len(raw) + 9, "<u8", buf, strides=(1,)) if len(raw) else np.zeros(1, U64)
    low = eight[start] & _MASKS[np.minimum(size, 8)]
    high = np.zeros(len(start), U64)
    more = np.flatnonzero(size > 8)
    high[more] = eight[start[more] + 8] & _MASKS[np.minimum(size[more] - 8, 8)]
    return Slice(buf, start, end, row_offs, low, high)


def _key(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return A.mix(low ^ A.mix(high + U64(1)))


def _slot(key: np.ndarray, slots: int) -> np.ndarray:
    return (key >> U64(64 - slots.bit_length() + 1)).astype(np.int64)


@dataclass
class Head:
    """Direct-mapped tables. A word's bytes and a pair's two slots are compared in full, so a hit is exact."""

    low: np.ndarray
    high: np.ndarray
    crc: np.ndarray
    pair: np.ndarray  # first slot * WORD_SLOTS + second slot, or -1
    bucket: np.ndarray

    def find(self, s: Slice) -> np.ndarray:
        """Slot of each word that the head has, else -1."""
        at = _slot(_key(s.low, s.high), WORD_SLOTS)
        hit = (self.low[at] == s.low) & (self.high[at] == s.high) & (s.end - s.start <= PACKED)
        return np.where(hit, at, -1)

    def find_pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Bucket of each pair of slots that the head has, else -1."""
        key = np.where((first >= 0) & (second >= 0), first * WORD_SLOTS + second, -2)
        at = _slot(A.mix(key.astype(U64)), PAIR_SLOTS)
        return np.where(self.pair[at] == key, self.bucket[at], -1)


def empty_head() -> Head:
    return Head(np.zeros(WORD_SLOTS, U64), np.zeros(WORD_SLOTS, U64), np.zeros(WORD_SLOTS, np.uint32), np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, np.int32))


def _unpack(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of packed words, a row of PACKED each, and their lengths."""
    b = np.ascontiguousarray(np.stack([low, high], 1)).astype("<u8").view(np.uint8).reshape(-1, PACKED)
    return b, np.count_nonzero(b, axis=1)


def build_head(words_: np.ndarray, pairs: np.ndarray, n_buckets: int) -> Head:
    """Tables from packed words (low, high) and pairs (low, high, low, high), most frequent first."""
    head = empty_head()
    low, high = words_[::-1, 0], words_[::-1, 1]  # of words with one slot the most frequent stays
    b, size = _unpack(low, high)
    base = np.arange(len(b)) * PACKED
    at = _slot(_key(low, high), WORD_SLOTS)
    head.low[at], head.high[at], head.crc[at] = low, high, crc_run(b.ravel(), base, base + size)
    first, second = pairs[::-1, :2], pairs[::-1, 2:]
    f, g = (_slot(_key(x[:, 0], x[:, 1]), WORD_SLOTS) for x in (first, second))
    known = (head.low[f] == first[:, 0]) & (head.high[f] == first[:, 1]) & (head.low[g] == second[:, 0]) & (head.high[g] == second[:, 1])
    f, g, second = f[known], g[known], second[known]
    b, size = _unpack(second[:, 0], second[:, 1])
    base = np.arange(len(b)) * PACKED
    crc = crc_run(b.ravel(), base, base + size, spaced(head.crc[f]))
    key = f * WORD_SLOTS + g
    at = _slot(A.mix(key.astype(U64)), PAIR_SLOTS)
    head.pair[at], head.bucket[at] = key, crc % np.uint32(n_buckets)
    return head


def buckets(s: Slice, head: Head, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, positions of the words that have a successor in their row, and buckets of those pairs."""
    n = len(s.start)
    slot = head.find(s)
    crc = np.empty(n, np.uint32)
    hit = slot >= 0
    crc[hit] = head.crc[slot[hit]]
    tail = np.flatnonzero(~hit)
    crc[tail] = crc_run(s.buf, s.start[tail], s.end[tail])
    last = np.zeros(n, bool)
    last[s.offs[1:][np.diff(s.offs) > 0] - 1] = True
    first = np.flatnonzero(~last)
    pair = head.find_pairs(slot[first], slot[first + 1])
    tail = np.flatnonzero(pair < 0)
    w = first[tail]
    pair[tail] = crc_run(s.buf, s.start[w + 1], s.end[w + 1], spaced(crc[w])) % np.uint32(n_buckets)
    return (crc % np.uint32(n_buckets)).astype(np.int64), first, pair.astype(np.int64)


def frequent(texts: DataFrame, n_buckets: int = N_BUCKETS) -> Head:
    """Head tables of the words of up to 16 bytes and their pairs that all texts hold most often.

    Each slice of text names those it holds ``SEEN`` times; counts are summed by Spark and only the
    largest, at most HEAD_WORDS and HEAD_PAIRS, reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.slices(batches, "text", SLICE):
            s = words(batch.column(0))
            if not len(s.start):
                continue
            _, at, own, n = np.unique(_key(s.low, s.high), return_index=True, return_inverse=True, return_counts=True)
            short = (s.end - s.start)[at] <= PACKED
            often = np.flatnonzero(short & (n >= SEEN))
            inside = np.ones(len(own), bool)
            inside[s.offs[1:][np.diff(s.offs) > 0] - 1] = False
            first = np.flatnonzero(inside)
            both = (short & (n >= SEEN))[own]
            first = first[both[first] & both[first + 1]] if len(first) else first
            key, m = np.unique(own[first] * len(at) + own[first + 1], return_counts=True)
            key, m = key[m >= SEEN], m[m >= SEEN]
            f, g = at[key // len(at)], at[key % len(at)]
            zero = np.zeros(len(often), U64)
            cols = [np.append(s.low[at[often]], s.low[f]), np.append(s.high[at[often]], s.high[f]), np.append(zero, s.low[g]), np.append(zero, s.high[g])]
            yield pa.RecordBatch.from_arrays([*[pa.array(c.view(np.int64)) for c in cols], pa.array(np.append(n[often], m))], ["a", "b", "c", "d", "n"])

    total = texts.select("text").mapInArrow(count, "a long, b long, c long, d long, n long").groupBy("a", "b", "c", "d").agg(F.sum("n").alias("n"))

    def most(rows: DataFrame, limit: int) -> np.ndarray:
        # counts by steps of a quarter of a power of two; only rows of the steps that fit reach the driver
        step = F.floor(4 * F.log2("n")).cast("int")
        fits, least = 0, None
        for r in sorted(rows.groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"]):
            fits += r["count"]
            if fits > limit:
                break
            least = r["s"]
        if least is None:
            return np.zeros((0, 4), U64)
        got = rows.where(step >= least).toPandas().sort_values(["n", "a", "b", "c", "d"], ascending=[False, True, True, True, True]).drop(columns="n")
        return np.ascontiguousarray(got.to_numpy(np.int64)).view(U64).reshape(-1, 4)

    total = cut_lineage(total)
    return build_head(most(total.where("c = 0"), HEAD_WORDS)[:, :2], most(total.where("c <> 0"), HEAD_PAIRS), n_buckets)


def bucket_totals(texts: DataFrame, head: Head, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Exact number of features of all texts in each bucket."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(n_buckets, np.int64)
        for batch in A.slices(batches, "text", SLICE):
            one, _, two = buckets(words(batch.column(0)), shared.value, n_buckets)
            acc += np.bincount(one, minlength=n_buckets) + np.bincount(two, minlength=n_buckets)
        at = np.flatnonzero(acc)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(acc[at])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # a row per bucket
    shared.unpersist()
    out = np.zeros(n_buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's add-one share in the target over that in the source."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, head: Head) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain of a document's features."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_, gain_ = shared.value
        for batch in A.slices(batches, "text", SLICE):
            s = words(batch.column(1))
            one, first, two = buckets(s, head_, len(gain_))
            sums = np.zeros(len(one) + 1, np.int64)
            each = gain_[one]
            each[first] += gain_[two]
            np.cumsum(each, out=sums[1:])
            n = np.diff(s.offs)
            m = np.maximum(2 * n - 1, 0)
            weight = (sums[s.offs[1:]] - sums[s.offs[:-1]]) // np.maximum(m, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(m), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, n_buckets: int = N_BUCKETS, use_head: bool = True) -> DataFrame:
    """Draw ``percent`` of the documents without replacement, the likelier the more their words look like ``target``.

    Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased. Documents of
    ``min_words`` words or more take part; their score is the weight (see ``weigh``) plus Gumbel noise that
    depends on ``seed`` and doc_id alone, and the highest floor(percent * N / 100) scores are drawn, ties to the smaller doc_id.

    One row per document: doc_id, n_features, weight, score, rank (from 1; null if not drawn). Three passes
    read the texts (head tables, totals, weights); only ids and numbers are shuffled, ranks come from written ranges.
    Null and empty texts have no features, weight 0, and are never drawn unless ``min_words`` is 0. A null doc_id
    has the noise of an empty id and sorts first; rows with one id share their noise; equal rows are rows of
    their own. An empty ``target`` gives gains by rarity in the source alone; an empty table gives no rows; other columns are not read.
    """
    head = frequent(docs, n_buckets) if use_head else empty_head()
    gain = gains(bucket_totals(docs, head, n_buckets), bucket_totals(target, head, n_buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut_lineage(weigh(docs, gain, head).withColumn("score", (F.col("weight") + noise).cast("long")))
    large = scored.where(F.col("n_words") >= min_words)
    drawn = large.count() * percent // 100
    ranked = positions(large, None, "score", "doc_id", "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")

"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard similarity on full shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A
from tallyloom.session import ensure_checkpoint_dir

FEATURES = "doc_id long, n long, h1 long, h2 long, sig binary"
SLICE = 1 << 19  # bytes of text at a time
_C = A.U64(0xD6E8FEB86659FD93)


def shingle_sets(col, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of each text, and row offsets. A text with fewer words than
    ``width`` is one shingle; one without words has none. A-Z are lower-cased."""
    buf, offs = A.column_bytes(col)
    w = A.words(A.ascii_lower(buf), offs)
    prefix = A.Prefix(w.value)
    n = np.diff(w.offs)
    count = np.where(n == 0, 0, np.maximum(1, n - width + 1))
    row = np.repeat(np.arange(len(n)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + w.offs[:-1][row]
    value = prefix.spans(start, np.minimum(start + width, w.offs[1:][row]))
    ends = np.cumsum(count)
    for s, e in zip((ends - count).tolist(), ends.tolist()):
        value[s:e].sort()
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[fresh], np.append(0, np.cumsum(fresh))[np.append(0, ends)]


def signatures(values: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash of the sets that begin at ``starts``: the first permutation places each shingle on
    a circle of 2**32 places, the second one, turned by one place per coordinate, is minimised."""
    place = (A.mix(values) >> A.U64(32)).astype(np.uint32)
    out = np.empty((len(starts), size), np.uint32)
    x, y = np.empty_like(place), np.empty_like(place)
    for k in range(size):
        np.add(place, np.uint32(k), out=x)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
            np.right_shift(x, np.uint32(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            if factor:
                np.multiply(x, np.uint32(factor), out=x)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def features(docs: DataFrame, width: int, size: int) -> DataFrame:
    """doc_id, number of shingles, two fingerprints of the whole set, signature (null without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.slices(batches, "text", SLICE):
            values, offs = shingle_sets(batch.column(1), width)
            n = np.diff(offs)
            some = np.flatnonzero(n)
            h1, h2 = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            sig: list = [None] * len(n)
            if len(some):
                starts = offs[:-1][some]
                h1[some] = np.add.reduceat(A.mix(values), starts).view(np.int64)
                h2[some] = np.add.reduceat(A.mix(values ^ _C), starts).view(np.int64)
                for i, s in zip(some.tolist(), signatures(values, starts, size)):
                    sig[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h1), pa.array(h2), pa.array(sig, pa.binary())], ["doc_id", "n", "h1", "h2", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FEATURES)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.slices(batches, "text", SLICE):
            values, offs = shingle_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([values[s:e].tobytes() for s, e in zip(offs[:-1], offs[1:])], pa.binary())], ["rep", "items"])

    return docs.select(F.col("doc_id").cast("long").alias("rep"), "text").mapInArrow(run, "rep long, items binary")


def similar(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * |A and B| >= percent * |A or B|."""
    if len(p) > len(q):
        p, q = q, p
    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
    common = int((q[at] == p).sum())
    return 100 * common >= percent * (len(p) + len(q) - common)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(sets.select(F.col("rep").alias("a"), F.col("items").alias("_x")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("items").alias("_y")), "b").select("a", "b", "_x", "_y").mapInArrow(run, "a long, b long")


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(rep, label): smallest id reachable from each linked id. Labels of an earlier call speed up."""
    ensure_checkpoint_dir(links.sparkSession)
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "rep")
    if labels is not None:
        now = now.join(labels.withColumnRenamed("label", "_old"), "rep", "full").select("rep", F.least("label", "_old").alias("label"))
        both = both.unionAll(labels.select(F.col("rep").alias("a"), F.col("label").alias("b"))).unionAll(labels.select(F.col("label").alias("a"), F.col("rep").alias("b")))
    now = now.checkpoint()
    while True:
        near = both.join(now.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "rep")
        low = now.join(near, "rep", "left").select("rep", F.col("label").alias("was"), F.least("label", "near").alias("low"))
        # follow the label once: ids of chains come together in a logarithmic number of rounds
        hop = now.select(F.col("rep").alias("low"), F.col("label").alias("hop"))
        then = low.join(hop, "low", "left").select("rep", "was", F.least("low", "hop").alias("label")).checkpoint()
        now = then.select("rep", "label")
        if then.where("label <> was").isEmpty():
            return now


def least_share(percent: int, size: int) -> float:
    """Share of equal coordinates that a pair at the threshold has but for five standard deviations."""
    p = percent / 100
    return p - 5 * (p * (1 - p) / size) ** 0.5


def likely(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose signatures (rep, sig) allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(v.as_buffer() for v in batch.column(i)), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((x == y).mean(1) >= least_share(percent, x.shape[1])))

    return pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("x")), "a").join(
        sigs.select(F.col("rep").alias("b"), F.col("sig").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def stubborn_links(members: DataFrame, features: DataFrame, bands: int, rows: int, percent: int, block: int = 1024) -> DataFrame:
    """Links (a, b) between components of one bucket that pivots have not joined.

    members: bucket, rep, n, label. features: rep, sig, items; only those that meet others take them along. In each bucket those outside the largest component meet all
    others, block by block. A pair is looked at in the first bucket that it shares; where its signatures
    allow the similarity the full sets decide. Each one outside hands on one link to each component of a
    block, never its candidates. Without ``items`` the result is who has candidates at all (bucket, rep).
    """
    with_items = "items" in features.columns
    sizes = members.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    big = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("c", "label")).alias("big"), F.sum("c").alias("all"), F.max("c").alias("most"), F.count("*").alias("labels")).where("labels > 1")
    every = members.join(big, "bucket").withColumn("stray", F.col("label") != F.col("big")).join(features, "rep")
    n_stray, n_all = (F.ceil(c / block).cast("int") for c in (F.col("all") - F.col("most"), F.col("all")))

    def part(n: Column, *seed: Column) -> Column:
        return F.pmod(F.xxhash64("rep", *seed), n).cast("int")

    def places(side: bool, i: Callable, j: Callable, n: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.lit(side).alias("side"), i(k).alias("i"), j(k).alias("j")))

    left = places(True, lambda k: part(n_stray, F.lit(1)), lambda k: k, n_all)
    right = places(False, lambda k: k, lambda k: part(n_all), n_stray)
    dealt = every.withColumn("at", F.explode(F.when(F.col("stray"), F.concat(left, right)).otherwise(right))).select(*members.columns, *features.drop("rep").columns, "stray", "at.*")

    def meet(t: pa.Table) -> pa.Table:
        side = t.column("side").to_numpy()
        rep, n, label = (t.column(c).to_numpy() for c in ("rep", "n", "label"))
        sig = np.frombuffer(b"".join(x.as_buffer() for x in t.column("sig").combine_chunks()), np.uint32).reshape(len(rep), -1)
        stray = t.column("stray").to_numpy()
        # the bucket number tells its band
        band = t.column("bucket")[0].as_py() % bands
        at_right = np.flatnonzero(~side)
        size = sig.shape[1]
        items = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("items").combine_chunks()] if with_items else []
        least, busy = least_share(percent, size), np.zeros(len(rep), bool)
        a, b = [], []
        for i in np.flatnonzero(side):
            ok = at_right[(label[at_right] != label[i]) & (100 * np.minimum(n[at_right], n[i]) >= percent * np.maximum(n[at_right], n[i])) & (~stray[at_right] | (rep[at_right] > rep[i]))]
            if len(ok):
                same = sig[ok] == sig[i]
                first = same.reshape(len(ok), bands, rows).all(2).argmax(1)
                ok = ok[(same.mean(1) >= least) & (first == band)]
                busy[ok] = True
                busy[i] |= len(ok) > 0
                found = set()
                for j in ok.tolist() if with_items else []:
                    if label[j] not in found and similar(items[i], items[j], percent):
                        found.add(label[j])
                        a.append(min(rep[i], rep[j]))
                        b.append(max(rep[i], rep[j]))
        if with_items:
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        return pa.table({"bucket": t.column("bucket").filter(pa.array(busy)), "rep": pa.array(rep[busy], pa.int64())})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(meet, "a long, b long" if with_items else "bucket long, rep long")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80, bands: int = 32, rows: int = 4) -> DataFrame:
    """Components of documents that are linked by similarity of ``percent`` per cent or more.

    Equal shingle sets are one class, represented by the smallest doc_id; only classes are compared. In
    each bucket of a band all members meet the bucket's smallest id first (a star, not all pairs), links are
    confirmed on full sets, and components follow. Buckets that still hold several components try another
    pivot, and in those left all outside the largest component meet all others in blocks. A pair at exactly the threshold is missed by all bands with
    probability (1 - 0.8**4)**32, about 4e-8.

    One row per input row: doc_id, n_shingles, component_id, kept. Null text, empty text and texts without
    words have no shingles and stand alone. Rows with a null id join their class but never represent it
    unless all of it is null (component_id null, kept). Rows with one id are all returned; ids are taken
    to name one text. An empty table gives no rows; other columns are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    feats = features(docs, width, bands * rows).checkpoint()
    some = feats.where("n > 0")
    classes = some.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("sig").alias("sig"))
    known = classes.where("rep IS NOT NULL").checkpoint()

    def band_rows(df: DataFrame, *more: str) -> DataFrame:
        # the low digits of a bucket's number are those of its band
        names = F.array(*[(F.shiftright(F.xxhash64(F.lit(i), F.substring("sig", 4 * rows * i + 1, 4 * rows)), 8) * bands + i) for i in range(bands)])
        return df.select("rep", "n", *more, F.explode(names).alias("bucket"))

    banded = band_rows(known)
    shared = banded.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("pivot"), F.count("*").alias("c")).where("c > 1").select("bucket", "pivot")
    members = banded.join(shared, "bucket").select("bucket", "rep", "n", "pivot").checkpoint()
    fits = F.least("n", "pivot.n") * 100 >= F.greatest("n", "pivot.n") * percent
    pairs = members.where((F.col("rep") != F.col("pivot.rep")) & fits).select(F.col("pivot.rep").alias("a"), F.col("rep").alias("b")).distinct()
    wanted = members.select("rep").distinct()
    sets = full_sets(docs.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), width).checkpoint()
    links = confirm(pairs, sets, percent).checkpoint()
    labels = components(links)

    def mixed(some: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components, with their labels."""
        marked = some.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        split = marked.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("bucket")
        return marked.join(split, "bucket", "left_semi")

    # another pivot for each of these buckets, by a hash, so that a document meets many of them
    sigs = known.select("rep", "sig").join(wanted, "rep", "left_semi").checkpoint()
    left = mixed(members.select("bucket", "rep", "n"), labels).checkpoint()
    second = left.groupBy("bucket").agg(F.min_by(F.struct("rep", "n", "label"), F.xxhash64("rep", "bucket")).alias("pivot"))
    others = left.join(second, "bucket").where(F.col("label") != F.col("pivot.label")).where(fits)
    pairs = likely(others.select(F.least("rep", "pivot.rep").alias("a"), F.greatest("rep", "pivot.rep").alias("b")).distinct(), sigs, percent)
    labels = components(confirm(pairs, sets, percent).checkpoint(), labels)
    again = mixed(left.drop("label"), labels).select("bucket", "rep", "n", "label").checkpoint()
    busy = stubborn_links(again, sigs, bands, rows, percent).distinct().checkpoint()
    labels = components(stubborn_links(again.join(busy, ["bucket", "rep"], "left_semi"), sigs.join(sets, "rep"), bands, rows, percent).distinct().checkpoint(), labels)

    of_class = classes.select("n", "h1", "h2", "rep").join(labels, "rep", "left").select("n", "h1", "h2", F.coalesce("label", "rep").alias("component"))
    single = feats.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    grouped = some.select("doc_id", "n", "h1", "h2").join(of_class, ["n", "h1", "h2"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return single.unionAll(grouped).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

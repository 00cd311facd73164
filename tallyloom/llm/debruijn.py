"""Removal of repeated word passages by compacted paths of a de Bruijn graph of words."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A
from tallyloom.llm import repeats as R
from tallyloom.llm.grouping import deal, size_of

STEP = "bucket int, g long, payload binary, row int, start long, n long, src_g long, src_row int, src_start long"
EDGE = "g long, row int, start long, n long, src_g long, src_row int, src_start long"
EDGE_COLUMNS = [x.split()[0] for x in EDGE.split(", ")]
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string, spans array<struct<start:long,end:long>>"
SOURCE = {"status": np.uint8, "src_g": np.int64, "src_row": np.int64, "src_at": np.int64}


def repeated_edges(docs: DataFrame, window: int = 20, k: int = 6, group_bytes: int = 1 << 20, bucket_bytes: int = 24 << 20, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(dealt documents, repeated edges). An edge is a window of ``window`` words, its two nodes the words
    without the last and without the first. Edges that share a minimiser and follow each other stay
    together (a super-k-mer): one row says that the ``n`` edges from word ``start`` of document (g, row)
    are those from word ``src_start`` of (src_g, src_row), which comes earlier.
    """
    _, n_bytes = size_of(docs)
    n_buckets = max(12, -(-n_bytes // bucket_bytes))
    dealt = deal(docs, n_bytes, group_bytes, keep)

    def load(t: pa.Table) -> R.Group:
        return R.load(t, window, k, n_buckets, by_word=True)

    def check(grp: R.Group, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return A.Prefix(A.mix(grp.words.value + A.U64(0x5851F42D4C957F2D))).spans(start, end)

    def say_contexts(t: pa.Table) -> pa.Table:
        grp = load(t)
        a, sent = grp.anchors, grp.sent
        row = a.row[sent]
        return R.send(grp, row, grp.bucket, key=(a.key[sent] >> A.U64(32)).astype(np.uint32), context=a.context[sent],
                      check=check(grp, a.first[sent], a.last[sent] + window), at=(a.first[sent] - grp.offs[row]).astype(np.uint32))

    def judge_contexts(t: pa.Table) -> pa.Table:
        return R.judge_contexts(t, strict_id=False, sources=True)

    def step(t: pa.Table, replies: pa.Table) -> pa.Table:
        """Edges that are settled as whole contexts, and packets with the single edges of the others."""
        if t.num_rows == 0:
            return _steps(R.packets([]), {})
        grp = load(t)
        a, sent = grp.anchors, grp.sent
        got = R.answers(grp, replies, grp.bucket, SOURCE)
        done = np.flatnonzero(got["status"] == R.SETTLED)
        own = sent[done]
        twin = np.flatnonzero(grp.head != np.arange(len(grp.head)))
        head = grp.head[twin]
        both = np.concatenate([own, twin])
        edges = {"row": a.row[both], "start": a.first[both] - grp.offs[a.row[both]], "n": a.last[both] - a.first[both] + 1,
                 "src_g": np.concatenate([got["src_g"][done], np.full(len(twin), grp.g)]),
                 "src_row": np.concatenate([got["src_row"][done], a.row[head]]),
                 "src_start": np.concatenate([got["src_at"][done], a.first[head] - grp.offs[a.row[head]]])}
        still = sent[got["status"] == R.OPEN]
        place, owner = R.windows_of(a.first[still], a.last[still])
        value = grp.prefix.spans(place, place + window)
        row = a.row[still][owner]
        bucket = ((value & A.U64(0xFFFFFFFF)) % A.U64(n_buckets)).astype(np.int64)
        packed = R.send(grp, row, bucket, value=value, check=check(grp, place, place + window), at=(place - grp.offs[row]).astype(np.uint32))
        return _steps(packed, edges | {"g": np.full(len(both), grp.g)})

    def judge_edges(t: pa.Table) -> pa.Table:
        box = R.gather(t)
        first = R.earliest(box.fields["value"], box.order)
        hit = np.flatnonzero((first != np.arange(len(first))) & (box.fields["check"] == box.fields["check"][first]))
        src = first[hit]
        at = box.fields["at"].astype(np.int64)
        return pa.table({"g": pa.array(box.g[hit], pa.int64()), "row": pa.array(box.row[hit], pa.int32()), "start": pa.array(at[hit], pa.int64()), "n": pa.array(np.ones(len(hit), np.int64)),
                         "src_g": pa.array(box.g[src], pa.int64()), "src_row": pa.array(box.row[src], pa.int32()), "src_start": pa.array(at[src], pa.int64())})

    contexts = dealt.groupBy("g").applyInArrow(say_contexts, R.PACKET).groupBy("bucket").applyInArrow(judge_contexts, R.PACKET)
    steps = dealt.groupBy("g").cogroup(contexts.groupBy("g")).applyInArrow(step, STEP)
    whole = steps.where("bucket IS NULL").select(*EDGE_COLUMNS)
    single = steps.where("bucket IS NOT NULL").select("bucket", "g", "payload").groupBy("bucket").applyInArrow(judge_edges, EDGE)
    return dealt, whole.unionAll(single)


def compact(edges: DataFrame) -> DataFrame:
    """Join edges into paths: an edge continues the one that ends where it starts, in the document and in
    its source alike. Paths without a branch become one row each; n counts edges."""
    ends = edges.select("g", "row", (F.col("start") + F.col("n")).alias("start"), "src_g", "src_row", (F.col("src_start") + F.col("n")).alias("src_start"), F.lit(True).alias("joined"))
    linked = edges.join(ends, ["g", "row", "start", "src_g", "src_row", "src_start"], "left")
    along = W.partitionBy("g", "row").orderBy("start")
    paths = linked.withColumn("path", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(along))
    return paths.groupBy("g", "row", "path").agg(F.min("start").alias("start"), F.sum("n").alias("n"), F.min("src_g").alias("src_g"), F.min("src_row").alias("src_row"), F.min("src_start").alias("src_start")).drop("path")


def dedup_words(docs: DataFrame, window: int = 20, keep: list[str] | None = None, **sizes) -> DataFrame:
    """Remove each word covered by a window of ``window`` words that also starts earlier: in a row that
    comes before (by doc_id; rows with one id in a fixed order), or before it in the same row.

    Words are runs of bytes other than 9 to 13 and 32, unchanged. Windows are judged on the input. Equality
    is that of two independent 64-bit fingerprints, compared at the source's coordinates.

    One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space),
    text (unchanged if nothing was removed, else the kept words joined), spans (word ranges removed as
    paths), and, with ``keep``, rest (a struct of these columns). Null and empty texts have no words, null text stays null; texts shorter than the window lose
    nothing; null ids come first; an empty table gives no rows; other columns are not read.
    """
    dealt, edges = repeated_edges(docs, window, keep=keep, **sizes)

    def cut(t: pa.Table, paths: pa.Table) -> pa.Table:
        rows = []
        if t.num_rows:
            by_row: dict[int, list] = {}
            for r, s, n in zip(*(paths.column(c).to_pylist() for c in ("row", "start", "n"))):
                by_row.setdefault(r, []).append((s, s + n - 1 + window))
            for i, (doc_id, text) in enumerate(_rows(t)):
                words = (text or "").encode().split()
                spans = sorted(by_row.get(i, ()))
                if spans:
                    gone = R.covered(len(words), np.array([s for s, _ in spans]), np.array([e for _, e in spans]))
                    kept = b" ".join(compress(words, (~gone).tolist()))
                    rows.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode(), [{"start": s, "end": e} for s, e in spans]))
                else:
                    rows.append((doc_id, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), text, []))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        out = R.table(rows, ["doc_id", "n_words", "n_removed", "kept_sha256", "text", "spans"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), span])
        return out.append_column("rest", R.ordered(t).column("rest")) if keep else out

    rest = f", rest {dealt.schema['rest'].dataType.simpleString()}" if keep else ""
    return dealt.groupBy("g").cogroup(compact(edges).groupBy("g")).applyInArrow(cut, OUT + rest)


def _rows(t: pa.Table) -> list[tuple]:
    """Rows in the order of ``repeats.load``."""
    t = R.ordered(t)
    return list(zip(t.column("doc_id").to_pylist(), t.column("text").to_pylist()))


def _steps(packed: pa.Table, edges: dict[str, np.ndarray]) -> pa.Table:
    types = {"row": pa.int32(), "start": pa.int64(), "n": pa.int64(), "src_g": pa.int64(), "src_row": pa.int32(), "src_start": pa.int64()}
    m, n = packed.num_rows, len(edges.get("row", ()))
    more = {"bucket": pa.nulls(n, pa.int32()), "g": pa.array(edges.get("g", []), pa.int64()), "payload": pa.nulls(n, pa.binary())}
    cols = {c: pa.concat_arrays([*packed.column(c).chunks, x]) for c, x in more.items()}
    for name, kind in types.items():
        cols[name] = pa.concat_arrays([pa.nulls(m, kind), pa.array(edges.get(name, []), kind)])
    return pa.table(cols)

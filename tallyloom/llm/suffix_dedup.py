"""Removal of byte passages that an earlier document has, by a logarithmic family of suffix arrays."""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import arrays as A
from tallyloom.llm import repeats as R
from tallyloom.llm.grouping import deal, size_of

OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start:long,end:long>>"


class SuffixLevels:
    """Suffix arrays of batches: sorted suffixes (their first ``window`` bytes), each with the smallest id.

    A new batch is sorted, merge-scanned against every level and becomes a level; while the two smallest
    levels are of like size they are merged, so a suffix is merged a logarithmic number of times.
    """

    def __init__(self, window: int):
        self.kind = f"S{window}"
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def _fold(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[start], np.minimum.reduceat(ids, start)

    def add(self, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Smallest id with each suffix, among this batch and all before it."""
        if len(keys) == 0:
            return ids
        new_keys, new_ids = self._fold(keys, ids)
        low = new_ids.copy()
        for level_keys, level_ids in self.levels:
            at = np.minimum(np.searchsorted(level_keys, new_keys), len(level_keys) - 1)
            same = level_keys[at] == new_keys
            low[same] = np.minimum(low[same], level_ids[at[same]])
        self.levels.append((new_keys, new_ids))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            self.levels.append(self._fold(np.concatenate([b, a]), np.concatenate([y, x])))
        return low[np.searchsorted(new_keys, keys)]


def dedup_bytes(docs: DataFrame, window: int = 50, k: int = 20, group_bytes: int = 1 << 20, bucket_bytes: int = 16 << 20, batch: int = 1 << 17, hot: int = 1 << 16) -> DataFrame:
    """Remove each byte covered by a ``window``-byte string that also starts in a row with a smaller doc_id.

    Texts are judged on the input. The suffixes that can match are found by minimiser (``repeats``); those
    that no whole context settles go, in the order of doc_id and in batches of about ``batch`` suffixes, to
    the suffix arrays of their minimiser's bucket, where full strings are compared. A minimiser with more
    than ``hot`` different contexts has no bucket: its suffixes, each once a group, are dealt by a hash of
    their own, as equal ones share it. Whole contexts (up to
    ``2 * window - k`` bytes) are compared by fingerprints (64 bits, and 32 of the minimiser).

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept
    (remaining bytes), spans. Null and empty texts have no bytes; texts shorter than the window lose
    nothing; null ids count as smaller than all others; rows with one id do not remove each other's
    bytes; an empty table gives no rows; other columns are not read.
    """
    n_rows, n_bytes = size_of(docs)
    n_buckets = max(12, -(-n_bytes // bucket_bytes))
    dealt = deal(docs, n_bytes, group_bytes)

    def load(t: pa.Table) -> R.Group:
        return R.load(t, window, k, n_buckets, by_word=False)

    def say_contexts(t: pa.Table) -> pa.Table:
        grp = load(t)
        a = grp.anchors
        return R.send(grp, a.row[grp.sent], grp.bucket, key=(a.key[grp.sent] >> A.U64(32)).astype(np.uint32), context=a.context[grp.sent])

    def judge_contexts(t: pa.Table) -> pa.Table:
        return R.judge_contexts(t, strict_id=True, sources=False, hot=hot)

    def open_contexts(grp: R.Group, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        status = R.answers(grp, replies, grp.bucket, {"status": np.uint8})["status"]
        return status, np.flatnonzero(status == R.OPEN)

    def hot_windows(grp: R.Group, status: np.ndarray):
        """Windows of hot contexts: start, anchor and number of the string; for each string itself, its smallest id, its bucket."""
        own = grp.sent[status == R.HOT]
        place, owner = R.windows_of(grp.anchors.first[own], grp.anchors.last[own])
        if not len(place):
            return place, owner, place, place, place, place
        text = np.lib.stride_tricks.sliding_window_view(grp.buf, window)
        keys, one, number = np.unique(np.ascontiguousarray(text[place]).view(f"S{window}").ravel(), return_index=True, return_inverse=True)
        low = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(low, number, grp.ids[grp.anchors.row[own[owner]]])
        start = place[one]
        return place, own[owner], number, keys, low, n_buckets + (grp.prefix.spans(start, start + window) % A.U64(4 * n_buckets)).astype(np.int64)

    def say_strings(t: pa.Table, replies: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return R.packets([])
        grp = load(t)
        status, still = open_contexts(grp, replies)
        a, out = grp.anchors, []
        for b, at in R.split(grp.bucket[still]):
            own = grp.sent[still[at]]
            length = a.last[own] - a.first[own] + window
            place, owner = R.windows_of(a.first[own], a.first[own] + length - 1)
            out.append((b, grp.g, _pickle({"ids": grp.ids[a.row[own]], "length": length.astype(np.uint16), "bytes": grp.buf[place].tobytes()})))
        _, _, _, keys, low, bucket = hot_windows(grp, status)
        out += [(b, grp.g, low[at].tobytes() + keys[at].tobytes()) for b, at in R.split(bucket)]
        return R.packets(out)

    def judge_hot(t: pa.Table) -> pa.Table:
        loads = [x.as_py() for x in t.column("payload")]
        gs, bucket = t.column("g").to_pylist(), t.column("bucket")[0].as_py()
        size = [len(x) // (8 + window) for x in loads]
        ids = np.concatenate([np.frombuffer(x, np.int64, n) for x, n in zip(loads, size)])
        keys = np.concatenate([np.frombuffer(x, f"S{window}", n, 8 * n) for x, n in zip(loads, size)])
        order = np.argsort(ids, kind="stable")
        family, low = SuffixLevels(window), np.zeros(len(ids), np.int64)
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            low[part] = family.add(keys[part], ids[part])
        ends = np.cumsum(size)
        return R.packets([(bucket, g, low[e - n : e].tobytes()) for g, n, e in zip(gs, size, ends)])

    def judge_strings(t: pa.Table) -> pa.Table:
        if t.column("bucket")[0].as_py() >= n_buckets:
            return judge_hot(t)
        loads = [_unpickle(x) for x in t.column("payload")]
        gs, bucket = t.column("g").to_pylist(), t.column("bucket")[0].as_py()
        ids = np.concatenate([x["ids"] for x in loads])
        length = np.concatenate([x["length"] for x in loads]).astype(np.int64)
        text = np.frombuffer(b"".join(x["bytes"] for x in loads), np.uint8)
        begin = np.cumsum(length) - length
        suffixes = np.lib.stride_tricks.sliding_window_view(text, window)
        count = length - window + 1
        order = np.argsort(ids, kind="stable")
        total = np.cumsum(count[order])
        hit = np.zeros(int(total[-1]), bool)
        offs = np.append(0, np.cumsum(count))
        family, i = SuffixLevels(window), 0
        while i < len(order):  # batches of whole contexts, in the order of ids
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + batch, "right")))
            part = order[i:j]
            place, owner = R.windows_of(begin[part], begin[part] + count[part] - 1)
            own = ids[part][owner]
            keys = np.ascontiguousarray(suffixes[place]).view(family.kind).ravel()
            low = family.add(keys, own)
            hit[R.windows_of(offs[part], offs[part] + count[part] - 1)[0]] = low < own
            i = j
        ends = np.cumsum([len(x["ids"]) for x in loads])
        return R.packets([(bucket, g, _pickle({"hit": np.packbits(hit[offs[e - len(x["ids"])] : offs[e]])})) for g, x, e in zip(gs, loads, ends)])

    def cut(t: pa.Table, replies: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return _result([], [], [], [])
        grp = load(t)
        a = grp.anchors
        kinds = replies.column("kind").to_numpy() if replies.num_rows else np.zeros(0)
        status, still = open_contexts(grp, replies.filter(pa.array(kinds == 1)))
        gone = [(a.first[grp.sent[status == R.SETTLED]], a.last[grp.sent[status == R.SETTLED]] + window)]
        # equal contexts of this group with a larger id than the first; those with its id fare as it does
        twins = np.flatnonzero((grp.head != np.arange(len(grp.head))))
        larger = twins[grp.ids[a.row[twins]] > grp.ids[a.row[grp.head[twins]]]]
        gone.append((a.first[larger], a.last[larger] + window))
        same = np.setdiff1d(twins, larger, assume_unique=True)
        state = np.zeros(len(grp.head), np.uint8)
        state[grp.sent] = status
        settled = same[state[grp.head[same]] == R.SETTLED]
        gone.append((a.first[settled], a.last[settled] + window))
        places = dict(R.split(grp.bucket[still]))
        strings = replies.filter(pa.array(kinds == 2))
        starts: dict[int, np.ndarray] = {}
        for b, payload in zip(strings.column("bucket").to_pylist(), strings.column("payload")):
            if b >= n_buckets:
                continue
            own = grp.sent[still[places[b]]]
            place, owner = R.windows_of(a.first[own], a.last[own])
            hit = np.unpackbits(_unpickle(payload)["hit"], count=len(place)).astype(bool)
            gone.append((place[hit], place[hit] + window))
            if len(same):
                for c in np.unique(owner[hit]):
                    starts[int(own[c])] = place[hit & (owner == c)] - a.first[own[c]]
        place, owner, number, keys, low, bucket = hot_windows(grp, status)
        if len(place):
            low, at = low.copy(), dict(R.split(bucket))
            for b, payload in zip(strings.column("bucket").to_pylist(), strings.column("payload")):
                if b >= n_buckets:
                    low[at[b]] = np.frombuffer(payload.as_py(), np.int64)
            hit = low[number] < grp.ids[a.row[owner]]
            gone.append((place[hit], place[hit] + window))
            if len(same):
                at = np.flatnonzero(hit)
                starts |= {c: place[at[x]] - a.first[c] for c, x in R.split(owner[at])}
        for c in same.tolist():
            if (h := int(grp.head[c])) in starts:
                place = starts[h] + a.first[c]
                gone.append((place, place + window))
        mask = R.covered(len(grp.buf), np.concatenate([x for x, _ in gone]), np.concatenate([y for _, y in gone]))
        rows, spans = [], []
        for d in range(len(grp.ids)):
            s, e = grp.text_offs[d], grp.text_offs[d + 1]
            m = mask[s:e]
            if m.any():
                step = np.diff(np.concatenate([[0], m.astype(np.int8), [0]]))
                runs = np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], 1)
                kept = grp.buf[s:e][~m].tobytes()
            else:
                runs, kept = np.zeros((0, 2), np.int64), grp.buf[s:e].tobytes()
            spans.append([{"start": int(x), "end": int(y)} for x, y in runs])
            rows.append((e - s, int(m.sum()), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        return _result(grp.ids, grp.null_id, rows, spans)

    first = dealt.groupBy("g").applyInArrow(say_contexts, R.PACKET).groupBy("bucket").applyInArrow(judge_contexts, R.PACKET)
    second = dealt.groupBy("g").cogroup(first.groupBy("g")).applyInArrow(say_strings, R.PACKET).groupBy("bucket").applyInArrow(judge_strings, R.PACKET)
    both = first.selectExpr("g", "1 AS kind", "bucket", "payload").unionAll(second.selectExpr("g", "2 AS kind", "bucket", "payload"))
    return dealt.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(cut, OUT)


def _pickle(x) -> bytes:
    return pickle.dumps(x, 5)


def _unpickle(x):
    return pickle.loads(x.as_buffer())


def _result(ids, null_id, rows, spans) -> pa.Table:
    cols = list(zip(*rows)) if len(rows) else [[], [], [], [], []]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({
        "doc_id": pa.array(ids, pa.int64(), mask=null_id) if len(ids) else pa.array([], pa.int64()),
        "n_bytes": pa.array(cols[0], pa.int64()), "n_removed": pa.array(cols[1], pa.int64()), "n_spans": pa.array(cols[2], pa.int64()),
        "kept_sha256": pa.array(cols[3], pa.string()), "kept": pa.array(cols[4], pa.binary()), "spans": pa.array(spans, kind)})

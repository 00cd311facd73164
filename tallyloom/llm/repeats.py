"""Passes shared by the two operators on repeated passages: super-k-mers by minimiser, then single windows.

A window is a run of W symbols (bytes or words) of one document. Windows that share a minimiser form a
context. Equal windows have equal minimisers, so all that can match meets in the bucket of the minimiser:

1. Every context sends (minimiser, fingerprint). Contexts equal to an earlier one are settled: each of
   their windows repeats. So are those whose minimiser occurs in one context only. What is left are first
   contexts that share a minimiser with a different one, about two at the ends of a repeated passage.
2. Only these send their windows, and learn which of them start earlier elsewhere.

Inside a group of documents equal contexts are sent once, so a passage in a third of all rows costs a
bucket one entry per group.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyloom.llm import arrays as A

LOWEST = -(1 << 63)
KEEP, SETTLED, OPEN, HOT = 0, 1, 2, 3
PACKET = "bucket int, g long, payload binary"


def table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def packets(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return table(rows, ["bucket", "g", "payload"], [pa.int32(), pa.int64(), pa.binary()])


@dataclass
class Group:
    """One group of documents, the same in every pass: rows by (doc_id, text), null ids first."""

    g: int
    ids: np.ndarray
    null_id: np.ndarray
    buf: np.ndarray
    text_offs: np.ndarray
    prefix: A.Prefix
    offs: np.ndarray
    words: A.Words | None
    anchors: A.Anchors
    head: np.ndarray  # index of the first equal context of this group, for each anchor
    sent: np.ndarray  # anchors that are such firsts
    bucket: np.ndarray  # of sent


def ordered(docs: pa.Table) -> pa.Table:
    """Rows by (doc_id, text), null ids first: the same order in every pass."""
    by = pa.table({"i": pc.fill_null(docs.column("doc_id"), LOWEST), "t": docs.column("text")})
    return docs.take(pc.sort_indices(by, sort_keys=[("i", "ascending"), ("t", "ascending")]))


def load(docs: pa.Table, window: int, k: int, n_buckets: int, by_word: bool) -> Group:
    docs = ordered(docs)
    g = docs.column("g")[0].as_py()
    raw = docs.column("doc_id")
    null_id = np.asarray(raw.is_null())
    ids = np.asarray(raw.fill_null(LOWEST), np.int64)
    buf, text_offs = A.column_bytes(docs.column("text"))
    words = A.words(buf, text_offs) if by_word else None
    prefix, offs = (A.Prefix(words.value), words.offs) if by_word else (A.byte_prefix(buf), text_offs)
    found = A.anchors(prefix, offs, window, k)
    _, first, inverse = np.unique(found.context, return_index=True, return_inverse=True)
    head = first[inverse] if len(first) else np.zeros(0, np.int64)
    sent = np.flatnonzero(head == np.arange(len(head)))
    bucket = ((found.key[sent] & A.U64(0xFFFFFFFF)) % A.U64(n_buckets)).astype(np.int64)  # the upper half goes along
    return Group(g, ids, null_id, buf, text_offs, prefix, offs, words, found, head, sent, bucket)


def split(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, positions) for each bucket that occurs; positions ascend."""
    order = np.argsort(bucket, kind="stable")
    names, start = np.unique(bucket[order], return_index=True)
    return list(zip(names.tolist(), np.split(order, start[1:])))


def send(group: Group, rows: np.ndarray, bucket: np.ndarray, **fields: np.ndarray) -> pa.Table:
    """One packet per bucket; ``rows`` are the documents (in group order) of the entries."""
    out = []
    for b, at in split(bucket):
        present, ordinal = np.unique(rows[at], return_inverse=True)
        out.append((b, group.g, pickle.dumps({"ids": group.ids[present], "rows": present.astype(np.int32), "ord": ordinal.astype(np.uint32)} | {n: v[at] for n, v in fields.items()}, 5)))
    return packets(out)


@dataclass
class Bucket:
    """The packets of one bucket, put together in the order of documents: doc_id, then group, then place."""

    bucket: int
    groups: list[int]
    sizes: list[int]
    ids: np.ndarray
    g: np.ndarray
    row: np.ndarray
    fields: dict[str, np.ndarray]
    order: np.ndarray  # entries from first to last


def gather(packed: pa.Table) -> Bucket:
    gs = packed.column("g").to_pylist()
    loads = [pickle.loads(x.as_buffer()) for x in packed.column("payload")]
    sizes = [len(x["ord"]) for x in loads]
    ids = np.concatenate([x["ids"] for x in loads])
    own = np.concatenate([np.full(len(x["ids"]), g, np.int64) for g, x in zip(gs, loads)])
    rows = np.concatenate([x["rows"] for x in loads])
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((rows, own, ids))] = np.arange(len(ids))
    base = np.cumsum([0] + [len(x["ids"]) for x in loads[:-1]])
    doc = np.concatenate([x["ord"].astype(np.int64) + b for b, x in zip(base, loads)])
    fields = {n: np.concatenate([x[n] for x in loads]) for n in loads[0] if n not in ("ids", "rows", "ord")}
    order = np.argsort(rank[doc], kind="stable")
    return Bucket(packed.column("bucket")[0].as_py(), gs, sizes, ids[doc], own[doc], rows[doc], fields, order)


def earliest(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each entry, the entry that comes first in ``order`` among those of equal value."""
    ranked = values[order]
    by = np.argsort(ranked, kind="stable")
    start = np.empty(len(by), bool)
    start[:1] = True
    start[1:] = ranked[by][1:] != ranked[by][:-1]
    firsts = order[by[np.flatnonzero(start)]]
    out = np.empty(len(values), np.int64)
    out[order[by]] = firsts[np.cumsum(start) - 1]
    return out


def answer(box: Bucket, **fields: np.ndarray) -> pa.Table:
    """Send results back to the groups, entry for entry as they came."""
    ends = np.cumsum(box.sizes)
    return packets([(box.bucket, g, pickle.dumps({n: v[e - s : e] for n, v in fields.items()}, 5)) for g, s, e in zip(box.groups, box.sizes, ends)])


def judge_contexts(packed: pa.Table, strict_id: bool, sources: bool, hot: int | None = None) -> pa.Table:
    """Bucket side of pass 1. Open contexts of a minimiser that has more than ``hot`` distinct ones are HOT."""
    box = gather(packed)
    first = earliest(box.fields["context"], box.order)
    me = np.arange(len(first))
    later = box.ids > box.ids[first] if strict_id else me != first
    status = np.where(later, SETTLED, KEEP).astype(np.uint8)
    # minimisers with more than one distinct context
    heads = np.unique(first)
    keys, n = np.unique(box.fields["key"][heads], return_counts=True)
    n = n[np.minimum(np.searchsorted(keys, box.fields["key"]), len(keys) - 1)]
    status[~later & (n > 1)] = OPEN
    # equal contexts have equal minimisers: 96 bits in all
    status[later & (box.fields["key"] != box.fields["key"][first])] = OPEN
    if hot is not None:
        status[(status == OPEN) & (n > hot)] = HOT
    if not sources:
        return answer(box, status=status)
    # a second, independent fingerprint: what differs there isn't the same passage
    status[(status == SETTLED) & (box.fields["check"] != box.fields["check"][first])] = OPEN
    settled = status == SETTLED
    return answer(box, status=status, **{n: np.where(settled, v[first], 0) for n, v in (("src_g", box.g), ("src_row", box.row), ("src_at", box.fields["at"]))})


def answers(group: Group, replies: pa.Table | None, bucket: np.ndarray, names: dict[str, type]) -> dict[str, np.ndarray]:
    """Put the replies of all buckets into the order of the entries that were sent."""
    out = {n: np.zeros(len(bucket), t) for n, t in names.items()}
    if replies is None or replies.num_rows == 0:
        return out
    places = dict(split(bucket))
    for b, payload in zip(replies.column("bucket").to_pylist(), replies.column("payload")):
        got = pickle.loads(payload.as_buffer())
        for n in names:
            out[n][places[b]] = got[n]
    return out


def windows_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts of all contexts, and the context of each."""
    n = last - first + 1
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[owner], owner


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask of the places in any [start, end)."""
    edge = np.bincount(start, minlength=n + 1)[: n + 1].astype(np.int64) - np.bincount(end, minlength=n + 1)[: n + 1]
    return np.cumsum(edge)[:n] > 0

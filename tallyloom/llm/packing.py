"""Packing of tokenised documents into sequences: best fit planned on a histogram of lengths."""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A
from tallyloom.session import ensure_checkpoint_dir

SLICE = 4 << 20
GENERATION = 150_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
_ODD = "\x1c\x1d\x1e\x1f"  # Python splits at these, the tokenizer doesn't
# letters whose lower case differs between the two; marks of tokens that are found before lower-casing
_AS_IS = ("\u0130", "\u03a3", "<|")
_SIGNS = "[!-/:-@\\[-`{-~]"
# signs behind a letter, up to the end of the word: units of their own
_TAIL = re.compile(rf"{_SIGNS}(?<=[^\W\d_]{_SIGNS}){_SIGNS}*(?=\s|$)")


class TokenBytes:
    """Ids of texts as little-endian 32-bit words. Words repeat, so each is tokenised once while it is
    remembered; the tokenizer never joins anything across white space.

    Words of the current generation and the one before are remembered; a full generation makes way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size()
        self.ends_word = np.array([(self.tok.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def _fresh(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters are one unit each, which ends in a token that ends words; many are encoded as one text."""
        letters = [w for w in words if w.isalpha()]
        others = [w for w in words if not w.isalpha()]
        out = dict(zip(others, self._encode(others)))
        for i in range(0, len(letters), 4096):
            part = letters[i : i + 4096]
            ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast([" ".join(part[j : j + 256]) for j in range(0, len(part), 256)], add_special_tokens=False)])
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
                out.update((w, raw[s:e]) for w, s, e in zip(part, at, at[1:]))
            else:
                out.update(zip(part, self._encode(part)))
        return out

    def _learn(self, words: set[str]) -> None:
        """Afterwards ``new`` holds all words."""
        missing = words.difference(self.new)
        known = missing.intersection(self.old)
        self.new.update(zip(known, map(self.old.__getitem__, known)))
        self.new.update(self._fresh(list(missing - known)))

    def _words(self, text: str) -> list[str] | None:
        """Words in lower case, with signs behind them apart, which gives the tokenizer's own ids; None for a text that must be encoded whole."""
        if any(c in text for c in _ODD):
            return None
        if not any(c in text for c in _AS_IS) and unicodedata.is_normalized("NFC", text):
            text = _TAIL.sub(r" \g<0>", text.lower())
        return text.split()

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        self._learn(set().union(*[ws for ws in split if ws]))
        get = self.new.__getitem__
        out = [self._encode([t])[0] if ws is None else b"".join(map(get, ws)) for t, ws in zip(texts, split)]
        if len(self.new) > GENERATION:
            self.old, self.new = self.new, {}
        return out


@cache
def token_bytes(path: str) -> TokenBytes:
    """One per worker process, which serves many tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return TokenBytes(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Token ids of each document with ``end_id`` behind them, cut at ``capacity``."""
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(tokenizer)
        for batch in A.slices(batches, "text", SLICE):
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += end
                for n, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    out.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            cols = list(zip(*out))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def plan_best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit by decreasing length over counts: rows (length, first rank, number, first sequence, offset).

    Sequences with equal room form runs of neighbouring numbers. All pieces of a length are put at once
    into the run with the least sufficient room, each sequence taking as many as it has room for; a run is
    split where the pieces end. The work depends on ``capacity``, not on the number of pieces.
    """
    rooms: list[int] = []  # sorted rooms that have runs
    runs: dict[int, list[tuple[int, int]]] = {}
    out, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in runs:
                insort(rooms, room)
                runs[room] = []
            runs[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[i]
            else:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = room // length
            full = min(n, left // each)
            tail = left - full * each if full < n else 0
            for j in range(each if full else 0):
                out.append((length, rank, full, first, capacity - room + j * length))
                rank += full
            for j in range(tail):
                out.append((length, rank, 1, first + full, capacity - room + j * length))
                rank += 1
            left -= full * each + tail
            put(room - each * length, first, full)
            if tail:
                put(room - tail * length, first + full, 1)
            rest = full + (tail > 0)
            put(room, first + rest, n - rest)
    return np.array(out, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens; only longer ones are cut.

    The pieces are written once. Counts per length and partition give the histogram, from which the driver
    plans (at most ``capacity`` lengths), and each partition's first rank within a length. A piece takes
    the slot that the plan has for its rank within its length.

    One row per piece: doc_id, piece, start, length, ids_crc32, ids (null unless asked for), sequence_id,
    offset. Null and empty texts are a document of the end token alone; rows with equal or null ids are
    documents of their own; an empty table gives no rows; other columns are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    pieces = token_pieces(docs, tokenizer, capacity, end_id, keep_ids).withColumn("_part", F.spark_partition_id()).checkpoint()
    counts = pieces.groupBy("length", "_part").agg(F.count("*").alias("_n")).checkpoint()
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = plan_best_fit(total, capacity)
    ahead = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    base = counts.select("length", "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    ranked = pieces.withColumn("_row", F.row_number().over(W.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32"))).join(base, ["length", "_part"])
    slots = docs.sparkSession.sparkContext.broadcast(plan)  # at most some rows per length and room

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = slots.value
        key = rows[:, 0] << 48 | rows[:, 1]
        order = np.argsort(key)
        rows, key = rows[order], key[order]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = rows[np.searchsorted(key, length << 48 | rank, "right") - 1]
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])], [*batch.schema.names[:6], "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("_base") + F.col("_row") - 1).alias("_rank")).mapInArrow(place, PIECES + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence with its token ids (little-endian 32-bit), from pieces that keep their ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"), F.sum("length").alias("length"))
    return parts.select("sequence_id", "length", F.aggregate("_p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))

"""Benchmark items in training documents: word n-grams as seeds, Smith-Waterman alignment as proof."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A

SLICE = 1 << 19  # bytes of text at a time
BLOCK_WORDS = 400_000  # words of test items that are broadcast at a time
MATCH, MISMATCH, GAP = 2, -1, -1
PAIRS = 1 << 18  # hits, each with one item, that are looked at together
CELLS = 4 << 20
_APART = np.zeros(256, bool)
_APART[:128] = [not chr(i).isalnum() for i in range(128)]
OUT = "doc_id long, item_id long, score double, first_word long, last_word long, n_seeds int"


@dataclass
class Items:
    """Words of test items, and their n-grams sorted by fingerprint (gram, item, place)."""

    ids: list
    words: np.ndarray
    offs: np.ndarray
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    door: np.ndarray | None = None  # bits of the grams' low ends; most text ends here
    distinct: np.ndarray | None = None  # grams
    by_item: np.ndarray | None = None  # (number of the gram, item), ascending as the grams are
    vocabulary: np.ndarray | None = None
    own: np.ndarray | None = None  # (item, word of the vocabulary), each once, ascending
    own_offs: np.ndarray | None = None  # of the items in own
    slot: np.ndarray | None = None  # place in the item's part of own, for each word

    def close(self) -> Items:
        self.door = np.zeros(1 << 22, bool)
        self.door[self.gram & A.U64((1 << 22) - 1)] = True
        self.distinct, number = np.unique(self.gram, return_inverse=True)
        self.by_item = number * len(self.ids) + self.item
        self.vocabulary, word = np.unique(self.words, return_inverse=True)
        self.own, at = np.unique(A.row_of(self.offs) * len(self.vocabulary) + word, return_inverse=True)
        self.own_offs = np.searchsorted(self.own, np.arange(len(self.ids) + 1) * len(self.vocabulary))
        self.slot = at - self.own_offs[A.row_of(self.offs)]
        return self


def plain_words(col) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of lower-cased runs of letters, digits and non-ASCII bytes, and row offsets."""
    buf, offs = A.column_bytes(col)
    low = A.ascii_lower(buf)
    start, end, row_offs = A.word_ranges(low, offs, _APART)
    return (A.byte_prefix(low).spans(start, end) if len(start) else np.zeros(0, A.U64)), row_offs


def grams(words: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first word and fingerprint of each n-gram that lies in one row."""
    value = A.Prefix(words).windows(n)
    at = np.arange(len(value))
    inside = at + n <= offs[1:][A.row_of(offs)[: len(value)]]
    return at[inside], value[inside]


def load_items(rows: list[tuple], n: int) -> Items:
    words, offs = plain_words(pa.array([t for _, t in rows], pa.string()))
    at, value = grams(words, offs, n)
    order = np.argsort(value, kind="stable")
    at, value = at[order], value[order]
    item = A.row_of(offs)[at] if len(at) else at
    return Items([i for i, _ in rows], words, offs, value, item, at - offs[item]).close()


def seen(items: Items, value: np.ndarray) -> np.ndarray:
    """Positions in ``value`` whose gram is one of the items'."""
    maybe = np.flatnonzero(items.door[value & A.U64((1 << 22) - 1)])
    if not len(items.gram):
        return maybe[:0]
    at = np.minimum(np.searchsorted(items.gram, value[maybe]), len(items.gram) - 1)
    return maybe[items.gram[at] == value[maybe]]


def align(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman scores of row pairs (padded words and lengths), with linear gaps, and the ends of the
    best local alignments in a and b. All pairs advance together, a row of a at a time."""
    rows, width = b.shape
    steps = -GAP * np.arange(width + 1)
    h = np.zeros((rows, width + 1), np.int32)
    best, end_a, end_b = np.zeros(rows, np.int32), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    inside = np.arange(width) < n_b[:, None]
    for i in range(a.shape[1]):
        same = (a[:, i, None] == b) & inside & (i < n_a)[:, None]
        now = np.zeros_like(h)
        np.maximum(h[:, :-1] + np.where(same, MATCH, MISMATCH), h[:, 1:] + GAP, out=now[:, 1:])
        np.maximum(now, 0, out=now)
        # gaps along b: the best earlier place of the row less its distance
        h = (np.maximum.accumulate(now + steps, axis=1) - steps).astype(np.int32)
        h[:, 1:][~inside] = 0
        top = h.argmax(1)
        high = h[np.arange(rows), top]
        better = (high > best) & (i < n_a)
        best[better], end_a[better], end_b[better] = high[better], i + 1, top[better]
    return best, end_a, end_b


def padded(words: np.ndarray, start: np.ndarray, n: np.ndarray, fill: int) -> np.ndarray:
    at = start[:, None] + np.arange(max(1, n.max()))
    out = words[np.minimum(at, len(words) - 1)]
    out[np.arange(out.shape[1]) >= n[:, None]] = A.U64(fill)
    return out


def reach(it: Items, item: np.ndarray, known: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """No alignment of an item with the words ``first`` to ``last`` scores more than this: a word of the item
    matches if the passage has it anywhere, and costs a step between others if not. ``known`` are the words
    by their numbers in the vocabulary, or -1."""
    out = np.zeros(len(item), np.int64)
    length = np.diff(it.offs)[item]
    cost = np.cumsum(last - first + length)
    i = 0
    while i < len(item):
        j = max(i + 1, int(np.searchsorted(cost, (cost[i - 1] if i else 0) + CELLS // 4, "right")))
        own, n = item[i:j], last[i:j] - first[i:j]
        owner = np.repeat(np.arange(j - i), n)
        word = known[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[i:j][owner]]
        owner, word = owner[word >= 0], word[word >= 0]
        key = own[owner] * len(it.vocabulary) + word
        at = np.minimum(np.searchsorted(it.own, key), len(it.own) - 1)
        size = np.diff(it.own_offs)[own]
        base = np.cumsum(size) - size
        there = np.zeros(size.sum(), bool)
        same = it.own[at] == key
        there[base[owner[same]] + at[same] - it.own_offs[own[owner[same]]]] = True
        run, best = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
        for p in range(length[i:j].max()):
            on = np.flatnonzero(p < length[i:j])
            step = np.where(there[base[on] + it.slot[it.offs[own[on]] + p]], MATCH, max(MISMATCH, GAP))
            run[on] = np.maximum(run[on] + step, 0)
            best = np.maximum(best, run)
        out[i:j] = best
        i = j
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5) -> DataFrame:
    """Pairs of a document (doc_id, text) and a test item (item_id, text) that it holds, maybe edited.

    Seeds: all n-grams of the items' words, however frequent they are; letters are lower-cased on both sides.
    Hits of one item in one document that lie within an item's
    length of each other make a passage, with as many words around it as an alignment of score ``least`` can
    have. It is aligned, be it for a single hit, unless the words it shares with the item cannot add up to ``least`` (``reach``). Equal passages
    are aligned once for the rows at hand. So every pair is found whose alignment has ``n`` equal words in a row;
    one without (every third word replaced, at a score of 0.5) is not. The score is that of the best alignment over that of the item with itself; pairs of
    ``least`` and more are returned, one row per pair: doc_id, item_id, score, first_word and last_word of
    the aligned passage (words as ``plain_words`` has them), n_seeds.

    Items go to the tasks in blocks of bounded size. Null and empty texts, and items of fewer than ``n``
    words, match nothing. Repeated documents or items are pairs of their own unless both ids are equal, when the
    best stays. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    bench = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
    total = bench.agg(F.coalesce(F.sum(F.size(F.split("text", " "))), F.lit(0)).alias("w")).first()["w"]
    n_blocks = max(1, -(-int(total) // BLOCK_WORDS))
    # no rows, and no Python workers of a kind that nothing else uses
    found = spark.range(0).selectExpr(*[f"CAST(id AS {kind}) AS {name}" for name, kind in (c.split() for c in OUT.split(", "))])
    for b in range(n_blocks):
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b)
        rows = sorted((tuple(r) for r in part.collect()), key=str)  # bounded by BLOCK_WORDS
        items = load_items(rows, n)
        if not len(items.gram):
            continue
        found = found.unionAll(_pairs(texts, items, n, least))
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("first_word")).alias("_f"), "last_word", "n_seeds")).alias("_b")).select(
        "doc_id", "item_id", "_b.score", (-F.col("_b._f")).alias("first_word"), "_b.last_word", "_b.n_seeds")


def _parts(it: Items, at: np.ndarray, row: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hits with each of their seeds, as place in the text and seed, in parts of about ``PAIRS``. The hits of one
    row and item stay together."""
    todo = [(0, len(at), 0, len(it.ids))]
    while todo:
        i, j, a, b = todo.pop()
        lo, hi = (np.searchsorted(it.by_item, number[i:j] * len(it.ids) + x) for x in (a, b))
        each = hi - lo
        if (n := int(each.sum())) > PAIRS and row[i] != row[j - 1]:
            m = int(np.searchsorted(row, row[(i + j) // 2], "left"))
            m = m if m > i else int(np.searchsorted(row, row[i], "right"))
            todo += [(m, j, a, b), (i, m, a, b)]
        elif n > PAIRS and b - a > 1:
            todo += [(i, j, (a + b) // 2, b), (i, j, a, (a + b) // 2)]
        elif n:
            yield np.repeat(at[i:j], each), np.arange(n) - np.repeat(np.cumsum(each) - each, each) + np.repeat(lo, each)


def _pairs(texts: DataFrame, items: Items, n: int, least: float) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it: Items = shared.value
        length = np.diff(it.offs)
        # with more words of the text left out, the score is below ``least``
        gaps = np.floor(MATCH * length * (1 - least) / -GAP).astype(np.int64) + 1
        for batch in A.slices(batches, "text", SLICE):
            words, offs = plain_words(batch.column(1))
            at, value = grams(words, offs, n)
            hit = seen(it, value)
            if not len(hit):
                continue
            place_row = A.row_of(offs)
            known = np.minimum(np.searchsorted(it.vocabulary, words), len(it.vocabulary) - 1)
            known[it.vocabulary[known] != words] = -1
            prefix = A.Prefix(words)
            for place, seed in _parts(it, at[hit], place_row[at[hit]], np.searchsorted(it.distinct, value[hit])):
                row, item = place_row[place], it.item[seed]
                order = np.lexsort((place, item, row))
                place, row, item, seed = place[order], row[order], item[order], seed[order]
                new = np.ones(len(place), bool)
                new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > length[item[1:]])
                begin = np.flatnonzero(new)
                hits = np.diff(np.append(begin, len(place)))
                first = np.minimum.reduceat(place - it.place[seed], begin)
                last = np.maximum.reduceat(place - it.place[seed] + length[item], begin)
                row, item = row[begin], item[begin]
                first, last = np.maximum(first - gaps[item], offs[row]), np.minimum(last + gaps[item], offs[row + 1])
                good = np.flatnonzero(reach(it, item, known, first, last) >= least * MATCH * length[item])
                if not len(good):
                    continue
                # equal passages of an item: the first stands for all
                same = np.stack([item[good].astype(A.U64), prefix.spans(first[good], last[good]), (last - first)[good].astype(A.U64)], 1)
                _, lead, group = np.unique(same, axis=0, return_index=True, return_inverse=True)
                lead, group = good[lead], group.ravel()
                members = np.split(good[np.argsort(group, kind="stable")], np.cumsum(np.bincount(group))[:-1])
                turn = np.argsort(last[lead] - first[lead], kind="stable")
                out = []
                i = 0
                while i < len(turn):  # passages of like length together, about four million cells at a time
                    j = i + 1
                    while j < len(turn) and (j + 1 - i) * (last[lead[turn[j]]] - first[lead[turn[j]]]) < 200_000:
                        j += 1
                    own = lead[turn[i:j]]
                    a = padded(it.words, it.offs[item[own]], length[item[own]], 1)
                    passage = padded(words, first[own], last[own] - first[own], 2)
                    score, end_a, end_b = align(a, length[item[own]], passage, last[own] - first[own])
                    part = score / (MATCH * length[item[own]])
                    for c in np.flatnonzero(part >= least).tolist():
                        x, y = end_a[c], end_b[c]
                        back = align(a[c : c + 1, :x][:, ::-1], np.array([x]), passage[c : c + 1, :y][:, ::-1], np.array([y]))
                        for m in members[turn[i + c]]:
                            start = first[m] - offs[row[m]]
                            out.append((batch.column(0)[int(row[m])].as_py(), it.ids[item[m]], float(part[c]), int(start + y - back[2][0]), int(start + y - 1), int(hits[m])))
                    i = j
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()])],
                                                     ["doc_id", "item_id", "score", "first_word", "last_word", "n_seeds"])

    return texts.mapInArrow(run, OUT)

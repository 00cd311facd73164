"""Language of documents and of spans in them: scripts, per-word scores, Viterbi with a switching penalty."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A

BUCKETS = 1 << 16  # hashed byte n-grams
ORDERS = (1, 2, 3, 4)
SLICE = 2 << 20
WORDS = 1 << 14
UND = "und"
# fixed values: first code points of Unicode ranges, and the script of each (0: no letters)
RANGES = [
    (0x0000, ""), (0x0041, "Latin"), (0x005B, ""), (0x0061, "Latin"), (0x007B, ""), (0x00AA, "Latin"), (0x00AB, ""), (0x00B5, "Latin"),
    (0x00B6, ""), (0x00BA, "Latin"), (0x00BB, ""), (0x00C0, "Latin"), (0x00D7, ""), (0x00D8, "Latin"), (0x00F7, ""), (0x00F8, "Latin"),
    (0x0300, ""), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, ""), (0x2C00, "Other"), (0x2E00, ""), (0x3041, "Kana"), (0x3100, "Other"), (0x3130, "Hangul"), (0x3190, ""),
    (0x3400, "Han"), (0x4DC0, ""), (0x4E00, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD800, ""), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB07, "Other"), (0xFE00, ""), (0xFE70, "Arabic"), (0xFF00, ""), (0xFF21, "Latin"), (0xFF3B, ""), (0xFF41, "Latin"), (0xFF5B, ""),
    (0xFF66, "Kana"), (0xFFE0, ""), (0x10000, "Other"), (0x1F000, ""), (0x20000, "Han"), (0x30000, ""),
]
SCRIPTS = ["", *sorted({s for _, s in RANGES if s})]
_FIRST = np.array([x for x, _ in RANGES])
_SCRIPT = np.array([SCRIPTS.index(s) for _, s in RANGES], np.uint8)
LATIN = SCRIPTS.index("Latin")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


@dataclass
class WordStream:
    """Letter runs of a batch: n-gram buckets per byte, and each word's bytes, row and script."""

    buckets: list[np.ndarray]
    start: np.ndarray
    end: np.ndarray
    offs: np.ndarray
    script: np.ndarray


def byte_scripts(buf: np.ndarray) -> np.ndarray:
    """Script of the character that each byte belongs to (0: not a letter)."""
    out = np.where(_ASCII_LETTER[buf], LATIN, 0).astype(np.uint8)
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        size = 2 + (buf[lead] >= 0xE0) + (buf[lead] >= 0xF0)
        lead, size = lead[lead + size <= len(buf)], size[lead + size <= len(buf)]
        code = buf[lead].astype(np.int64) & (0x7F >> size)
        for i in (1, 2, 3):
            more = size > i
            code[more] = code[more] << 6 | buf[lead[more] + i] & 0x3F
        script = _SCRIPT[np.searchsorted(_FIRST, code, "right") - 1]
        for i in range(4):
            within = size > i
            out[lead[within] + i] = script[within]
    return out


def word_stream(col) -> WordStream:
    """Words are runs of letters; n-grams of lower-cased bytes include the word's borders."""
    buf, offs = A.column_bytes(col)
    kind = byte_scripts(buf)
    # runs of letters, cut between rows as well
    start, end, row_offs = A.word_ranges(kind, offs, np.arange(256) == 0)
    low = A.ascii_lower(buf).astype(np.uint32)
    low[kind == 0] = 0
    n = len(low)
    edge = np.zeros(n + 3, np.uint32)
    edge[3:] = low
    buckets = []
    for order in ORDERS:
        h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for i in range(order):
            h = (h ^ edge[3 - i : 3 - i + n]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        buckets.append((h >> np.uint32(16)).astype(np.uint16))
    script = np.full(len(start), LATIN, np.uint8)
    if len(start):
        # the highest script number other than Latin's decides, so mixed words take the rarer script
        other = np.where(kind == LATIN, 0, kind)
        top = np.maximum.reduceat(other, start) if n else other[:0]
        script = np.where(top > 0, top, LATIN).astype(np.uint8)
    return WordStream(buckets, start, end, row_offs, script)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (orders * BUCKETS, langs): log probabilities, centred over languages
    allowed: np.ndarray  # (scripts, langs)
    penalty: float = 6.0
    cap: float = 12.0

    def word_scores(self, w: WordStream) -> np.ndarray:
        if len(w.start) == 0:
            return np.zeros((0, len(self.langs)), np.float32)
        s = np.empty((len(w.start), len(self.langs)), np.float32)
        for i in range(0, len(s), WORDS):  # a bounded number of words at a time
            start, end = w.start[i : i + WORDS], w.end[i : i + WORDS]
            low, high = start[0], end[-1]
            per_byte = sum(self.weights[o * BUCKETS : (o + 1) * BUCKETS].take(b[low:high], axis=0) for o, b in enumerate(w.buckets))
            sums = np.zeros((high - low + 1, len(self.langs)))
            np.cumsum(per_byte, axis=0, out=sums[1:])
            s[i : i + WORDS] = sums[end - low] - sums[start - low]
        s = np.clip(s, -self.cap, self.cap)
        ok = self.allowed[w.script]
        s[~ok] = -2 * self.cap
        s[~ok.any(1)] = 0
        return s


def viterbi(scores: np.ndarray, offs: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word when a change of label costs ``penalty``; all rows advance together."""
    labels = np.zeros(len(scores), np.uint8)
    length = np.diff(offs)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    if not len(order):
        return labels
    begin, size = offs[:-1][order], length[order]
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # rows with more than t words
    best = scores[begin].copy()
    back = []
    for t in range(1, size[0]):
        m = active[t]
        now = best[:m]
        top = now.argmax(1)
        jump = now[np.arange(m), top][:, None] - penalty
        moved = now < jump
        back.append((top.astype(np.uint8), moved))
        best[:m] = np.where(moved, jump, now) + scores[begin[:m] + t]
    label = best.argmax(1)
    for t in range(size[0] - 1, 0, -1):
        m = active[t]
        labels[begin[:m] + t] = label[:m]
        top, moved = back[t - 1]
        label[:m] = np.where(moved[np.arange(m), label[:m]], top, label[:m])
    labels[begin] = label
    return labels


def train(docs: DataFrame, per_language: int = 3000, penalty: float = 6.0) -> Model:
    """Fit n-gram weights on rows with text and lang.

    ``per_language`` bounds the sample: about so many rows of each language, by a hash of the text; the
    whole text of each is used. Counts per hashed n-gram are summed by Spark; what comes to the driver is
    bounded by the number of buckets and languages.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((len(ORDERS) * BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool), penalty)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, per_language / sizes[lang]))])[F.col("lang")]
    sample = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20))
    number = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in A.slices(batches, "text", SLICE):
            own = np.array([number[x] for x in batch.column(1).to_pylist()])
            for lang in np.unique(own):
                w = word_stream(batch.column(0).take(pa.array(np.flatnonzero(own == lang))))
                n = len(w.buckets[0])
                inside = np.cumsum(np.bincount(w.start, minlength=n + 1) - np.bincount(w.end, minlength=n + 1))[:n] > 0
                acc = total.setdefault(int(lang), np.zeros(len(ORDERS) * BUCKETS + len(SCRIPTS), np.int64))
                for o, b in enumerate(w.buckets):
                    acc[o * BUCKETS : (o + 1) * BUCKETS] += np.bincount(b[inside], minlength=BUCKETS)
                acc[len(ORDERS) * BUCKETS :] += np.bincount(w.script, minlength=len(SCRIPTS))
        for lang, acc in total.items():
            at = np.flatnonzero(acc)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lang, np.int32)), pa.array(at.astype(np.int32)), pa.array(acc[at])], ["lang", "bucket", "n"])

    counts = sample.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    dense = np.zeros((len(ORDERS) * BUCKETS + len(SCRIPTS), len(langs)))
    dense[counts["bucket"], counts["lang"]] = counts["n"]
    scripts = dense[len(ORDERS) * BUCKETS :]
    weights = np.empty((len(ORDERS) * BUCKETS, len(langs)), np.float32)
    for o in range(len(ORDERS)):
        part = dense[o * BUCKETS : (o + 1) * BUCKETS]
        p = (part + 0.5) / (part.sum(0) + 0.5 * BUCKETS)
        log = np.log(p)
        weights[o * BUCKETS : (o + 1) * BUCKETS] = (log - log.mean(1, keepdims=True)) / len(ORDERS)
    return Model(langs, weights, scripts >= np.maximum(1, 0.01 * scripts.sum(0)), penalty)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Label the words of every whole text and sum up.

    A word's script (fixed Unicode ranges) leaves the languages that use it; byte n-grams score these;
    Viterbi with ``model.penalty`` per change labels the words. Adds lang_pred (the language with most
    letters' bytes), score (its share of them, 0 to 1) and spans (language, and first and last word from 0
    of each maximal run). ``und`` with score 0 and no spans: null text, text without letters, or a model
    without languages. Letters in scripts that no language uses leave the choice to their neighbours.
    Columns of ``keep`` (default doc_id) come first; an empty table gives no rows.
    """
    keep = keep or ["doc_id"]
    given = list(keep)
    source = docs.select(*given) if "text" in given else docs.select(*given, "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by buckets and languages
    span = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in A.slices(batches, "text", SLICE):
            text = batch.column(batch.schema.get_field_index("text"))
            n = batch.num_rows
            w = word_stream(text)
            count = np.diff(w.offs)
            pred, score, spans = [UND] * n, np.zeros(n), [[] for _ in range(n)]
            if m.langs:
                labels = viterbi(m.word_scores(w), w.offs, m.penalty)
                row = A.row_of(w.offs)
                weight = np.bincount(row * len(m.langs) + labels, w.end - w.start, n * len(m.langs)).reshape(n, -1)
                top = weight.argmax(1)
                all_ = weight.sum(1)
                turn = np.ones(len(labels), bool)
                turn[1:] = (labels[1:] != labels[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(turn)
                last = np.append(first[1:], len(labels)) - 1
                for f, e in zip(first.tolist(), last.tolist()):
                    r = int(row[f])
                    spans[r].append({"lang": m.langs[labels[f]], "first": f - int(w.offs[r]), "last": e - int(w.offs[r])})
                for r in np.flatnonzero(count).tolist():
                    if w.script[w.offs[r] : w.offs[r + 1]].max() == LATIN == w.script[w.offs[r]] or _has_letter(text[r].as_py()):
                        pred[r], score[r] = m.langs[top[r]], weight[r, top[r]] / all_[r]
                    else:
                        spans[r] = []
                for r in np.flatnonzero(count == 0).tolist():
                    if _has_letter(text[r].as_py()):  # only letters that the ranges don't know
                        pred[r] = m.langs[0]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(given)], pa.array(pred, pa.string()), pa.array(score), pa.array(spans, span)], [*given, "lang_pred", "score", "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(given)])
    return source.mapInArrow(run, f"{fields}, lang_pred string, score double, spans array<struct<lang:string,first:long,last:long>>")


def _has_letter(text: str | None) -> bool:
    return any(unicodedata.category(c)[0] == "L" for c in text or "")

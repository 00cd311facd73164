"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy, over all windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A

WORD_BITS, CHAR_BITS, EMBED, HIDDEN = 17, 18, 8, 8
GRAMS = (3, 4, 5)
WINDOW, STRIDE = 32, 16
SLICE = 2 << 20
BLOCK = 4096
DECAY = 0.2
LEAST = 4
# what separates words: ASCII bytes other than letters, digits and the signs that stand for letters
_APART = np.zeros(256, bool)
_APART[:128] = [not (chr(i).isalnum() or chr(i) in "@$*'") for i in range(128)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Vocabulary:
    """Distinct words of a batch: hashed word, and hashed grams of 3 to 5 bytes with its left border."""

    word: np.ndarray
    chars: np.ndarray
    offs: np.ndarray

    def take(self, at: np.ndarray) -> Vocabulary:
        n = self.offs[at + 1] - self.offs[at]
        offs = np.append(0, np.cumsum(n))
        index = np.arange(offs[-1]) - np.repeat(offs[:-1], n) + np.repeat(self.offs[at], n)
        return Vocabulary(self.word[at], self.chars[index], offs)


def read_words(col) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """(vocabulary, number of each word in it, word offsets of the rows)."""
    buf, offs = A.column_bytes(col)
    low = A.ascii_lower(buf)
    start, end, row_offs = A.word_ranges(low, offs, _APART)
    if not len(start):
        return Vocabulary(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)), np.zeros(0, np.int64), row_offs
    value = A.byte_prefix(low).spans(start, end)
    distinct, first, number = np.unique(value, return_index=True, return_inverse=True)
    s, n = start[first], (end - start)[first]
    offs = np.append(0, np.cumsum(n))
    place = np.arange(offs[-1]) - np.repeat(offs[:-1], n)  # byte in its word
    letter = low[place + np.repeat(s, n)].astype(np.uint32)
    grams = np.empty((offs[-1], len(GRAMS)), np.int64)
    for i, size in enumerate(GRAMS):  # the gram that ends at each byte; 0 stands before the word
        h = np.full(len(letter), size, np.uint32)
        for back in range(size):
            past = np.concatenate([np.zeros(back, np.uint32), letter[: len(letter) - back]])
            h = (h ^ np.where(place >= back, past, 0)) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        grams[:, i] = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)
    return Vocabulary((distinct >> A.U64(64 - WORD_BITS)).astype(np.int64), grams.ravel(), offs * len(GRAMS)), number.ravel(), row_offs


def windows(row_offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every window, and its row. Rows without words have none; windows overlap by half
    and the last one ends with the row."""
    n = np.diff(row_offs)
    count = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)))
    row = np.repeat(np.arange(len(n)), count)
    i = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(i * STRIDE, np.maximum(0, n[row] - WINDOW))
    return row_offs[:-1][row] + start, np.minimum(n[row], WINDOW), row


def window_ids(start: np.ndarray, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    at = start[:, None] + np.minimum(np.arange(WINDOW), length[:, None] - 1)
    return number[at], None if (length == WINDOW).all() else np.arange(WINDOW) < length[:, None]


class Network:
    """Parameters by name; ``forward`` gives logits of windows, ``step`` one update of Adam."""

    def __init__(self, seed: int = 0, live_words: np.ndarray | None = None, live_chars: np.ndarray | None = None):
        r = np.random.default_rng(seed)
        # hashed inputs that training saw too rarely share row 0, which stays zero
        self.word_row, self.char_row = np.zeros(1 << WORD_BITS, np.int32), np.zeros(1 << CHAR_BITS, np.int32)
        for rows, live in ((self.word_row, live_words), (self.char_row, live_chars)):
            live = np.arange(len(rows)) if live is None else live
            rows[live] = np.arange(1, len(live) + 1)
        put = lambda *shape, scale: (r.normal(size=shape) * scale).astype(np.float32)
        self.p = {"ew": put(self.word_row.max() + 1, EMBED, scale=0.1), "ec": put(self.char_row.max() + 1, EMBED, scale=0.1)}
        self.p["ew"][0] = self.p["ec"][0] = 0
        for d in "fb":
            self.p |= {f"w{d}": put(2 * EMBED, 3 * HIDDEN, scale=0.25), f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"u{d}": put(HIDDEN, 3 * HIDDEN, scale=0.3), f"n{d}": np.zeros(HIDDEN, np.float32)}
        self.p |= {"wa": put(2 * HIDDEN, HIDDEN, scale=0.3), "ba": np.zeros(HIDDEN, np.float32), "va": put(HIDDEN, scale=0.3), "wo": put(2 * HIDDEN, scale=0.3), "bo": np.zeros(1, np.float32)}
        self.m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        self.t = 0
        self.shift, self.slope = 0.0, 1.0

    def inputs(self, v: Vocabulary) -> np.ndarray:
        if not len(v.word):
            return np.zeros((0, 2 * EMBED), np.float32)
        chars = np.add.reduceat(self.p["ec"][self.char_row[v.chars]], v.offs[:-1], axis=0) / np.sqrt(np.diff(v.offs))[:, None]
        return np.concatenate([self.p["ew"][self.word_row[v.word]], chars], 1).astype(np.float32)

    def run(self, d: str, proj: np.ndarray, ids: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
        h = np.zeros((len(ids), HIDDEN), np.float32)
        out = np.empty((WINDOW, len(ids), HIDDEN), np.float32)
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            g, a = proj[ids[:, t]], h @ self.p[f"u{d}"]
            zr = sigmoid(g[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            an = a[:, 2 * HIDDEN :] + self.p[f"n{d}"]
            n = np.tanh(g[:, 2 * HIDDEN :] + r * an)
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[:, t, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, n, an))
            out[t] = h = new
        return out

    def forward(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        kept = {"f": None, "b": None} if keep is None else {"f": [], "b": []}
        h = np.concatenate([self.run(d, x @ self.p[f"w{d}"] + self.p[f"b{d}"], ids, mask, kept[d]) for d in "fb"], 2)
        e = np.tanh(h @ self.p["wa"] + self.p["ba"])
        s = e @ self.p["va"]
        if mask is not None:
            s = np.where(mask.T, s, -30)
        s = np.exp(s - s.max(0))
        alpha = s / s.sum(0)
        pooled = (alpha[:, :, None] * h).sum(0)
        if keep is not None:
            keep |= {"h": h, "e": e, "alpha": alpha, "pooled": pooled, **kept}
        return pooled @ self.p["wo"] + self.p["bo"][0]

    def gradients(self, v: Vocabulary, ids: np.ndarray, mask: np.ndarray | None, y: np.ndarray) -> dict[str, np.ndarray]:
        k: dict = {}
        x = self.inputs(v)
        d_logit = ((sigmoid(self.forward(x, ids, mask, k)) - y) / len(y)).astype(np.float32)
        p, g = self.p, {"wo": k["pooled"].T @ d_logit, "bo": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["wo"]
        d_alpha = (k["h"] * d_pooled).sum(2)
        d_s = k["alpha"] * (d_alpha - (k["alpha"] * d_alpha).sum(0))
        d_e = d_s[:, :, None] * p["va"] * (1 - k["e"] ** 2)
        g["va"] = (k["e"] * d_s[:, :, None]).sum((0, 1))
        g["wa"] = np.tensordot(k["h"], d_e, ([0, 1], [0, 1]))
        g["ba"] = d_e.sum((0, 1))
        d_h = k["alpha"][:, :, None] * d_pooled + d_e @ p["wa"].T
        d_x = np.zeros_like(x)
        flat = np.argsort(ids.ravel(), kind="stable")
        names, begin = np.unique(ids.ravel()[flat], return_index=True)
        for d, part in (("f", d_h[:, :, :HIDDEN]), ("b", d_h[:, :, HIDDEN:])):
            d_proj = np.zeros((len(ids), WINDOW, 3 * HIDDEN), np.float32)
            g[f"u{d}"], g[f"n{d}"] = np.zeros_like(p[f"u{d}"]), np.zeros_like(p[f"n{d}"])
            carry = np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, n, an in reversed(k[d]):
                total = carry + part[t]
                on = 1 if mask is None else mask[:, t, None]
                dh = total * on
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                d_a = np.concatenate([dz, dr, dn * r], 1)
                d_proj[:, t] = np.concatenate([dz, dr, dn], 1)
                g[f"u{d}"] += h.T @ d_a
                g[f"n{d}"] += (dn * r).sum(0)
                carry = dh * z + d_a @ p[f"u{d}"].T + total * (1 - on)
            by_word = np.zeros((len(x), 3 * HIDDEN), np.float32)
            by_word[names] = np.add.reduceat(d_proj.reshape(-1, 3 * HIDDEN)[flat], begin, axis=0)
            g[f"w{d}"], g[f"b{d}"] = x.T @ by_word, by_word.sum(0)
            d_x += by_word @ p[f"w{d}"].T
        g["ew"], g["ec"] = np.zeros_like(p["ew"]), np.zeros_like(p["ec"])
        np.add.at(g["ew"], self.word_row[v.word], d_x[:, :EMBED])
        n = np.diff(v.offs)
        np.add.at(g["ec"], self.char_row[v.chars], np.repeat(d_x[:, EMBED:] / np.sqrt(n)[:, None], n, axis=0))
        g["ew"][0] = g["ec"][0] = 0
        return g

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for name, v in g.items():
            m, s = self.m[name]
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            if name in ("ew", "ec"):
                self.p[name] *= 1 - DECAY * rate
            self.p[name] -= (rate * m / (1 - 0.9**self.t) / (np.sqrt(s / (1 - 0.99**self.t)) + 1e-7)).astype(np.float32)

    def row_logits(self, v: Vocabulary, number: np.ndarray, row_offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Largest window logit of each row (-inf without words), and the window that has it."""
        start, length, row = win = windows(row_offs)
        logit = np.empty(len(start), np.float32)
        x = self.inputs(v)
        for some in (np.flatnonzero(length == WINDOW), np.flatnonzero(length < WINDOW)):  # only short rows need a mask
            for i in range(0, len(some), BLOCK):
                at = some[i : i + BLOCK]
                logit[at] = self.forward(x, *window_ids(start[at], length[at], number))
        best = np.full(len(row_offs) - 1, -np.inf, np.float32)
        top = np.full(len(best), -1, np.int64)
        if len(start):
            order = np.lexsort((logit, row))
            last = np.flatnonzero(np.append(row[order][1:] != row[order][:-1], True))
            top[row[order[last]]] = order[last]
            best[row[order[last]]] = logit[order[last]]
        return best, top, win

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return np.where(np.isfinite(logits), sigmoid(self.slope * (np.nan_to_num(logits, neginf=-30) - self.shift)), 0.0)


def fit(texts: list[str], labels: np.ndarray, share: float, epochs: int = 7, batch: int = 256, seed: int = 0) -> Network | None:
    """Train on whole texts. The first epoch takes random windows with their text's label; later ones take
    from each text the window that scores highest now, and from clean texts random ones too. At the end
    the threshold is set where errors are fewest when a ``share`` of all rows is toxic. None if a class is missing."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    vocab, number, row_offs = read_words(pa.array(texts))
    rows_of = np.bincount(np.unique(A.row_of(row_offs) * max(1, len(vocab.word)) + number) % max(1, len(vocab.word)), minlength=len(vocab.word))
    word_count = np.bincount(vocab.word, rows_of, 1 << WORD_BITS)
    char_count = np.bincount(vocab.chars, np.repeat(rows_of, np.diff(vocab.offs)), 1 << CHAR_BITS)
    net = Network(seed, np.flatnonzero(word_count >= LEAST), np.flatnonzero(char_count >= LEAST))
    for epoch in range(epochs):
        if epoch == 0:
            start, length, row = windows(row_offs)
            rank = np.lexsort((rng.random(len(row)), row))
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            pick = rank[nth < 6]
        else:
            _, top, (start, length, row) = net.row_logits(vocab, number, row_offs)
            best = top[top >= 0]
            toxic, clean = best[labels[row[best]] == 1], best[labels[row[best]] == 0]
            rest = np.flatnonzero(labels[row] == 0)
            # as many toxic windows as hard and random clean ones together
            pick = np.concatenate([np.resize(toxic, 2 * len(clean) if len(toxic) else 0), clean, rng.choice(rest, len(clean))])
        rng.shuffle(pick)
        for i in range(0, len(pick), batch):
            own = pick[i : i + batch]
            ids, mask = window_ids(start[own], length[own], number)
            names, local = np.unique(ids, return_inverse=True)
            net.step(net.gradients(vocab.take(names), local.reshape(ids.shape), mask, labels[row[own]].astype(np.float32)), 0.01 if epoch < 4 else 0.004)
    best, _, _ = net.row_logits(vocab, number, row_offs)
    best = np.nan_to_num(best, neginf=-30)
    order = np.argsort(best)
    y = labels[order]
    missed = np.append(0, np.cumsum(y)) * share / max(1, y.sum())
    false = (np.append(np.cumsum((1 - y)[::-1])[::-1], 0)) * (1 - share) / max(1, (1 - y).sum())
    low = np.flatnonzero(missed + false == (missed + false).min())
    edges = np.concatenate([[best[order[0]] - 1], best[order], [best[order[-1]] + 1]])
    cut = low[len(low) // 2]
    net.shift = float((edges[cut] + edges[cut + 1]) / 2)
    net.m = {}
    return net


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1000) -> Network | None:
    """Fit on whole texts of about ``per_class`` rows of each label (doc_id, toxic), chosen by a hash of the id."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).dropDuplicates(["doc_id"])
    got = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(sample), "doc_id").toPandas().sort_values(["doc_id", "text"])  # bounded by per_class
    return fit(got["text"].tolist(), got["toxic"].to_numpy(), sizes[1] / (sizes[0] + sizes[1]))


def score(docs: DataFrame, model: Network | None) -> DataFrame:
    """Score whole texts: the largest probability of all windows of ``WINDOW`` words, half overlapping.

    One row per input row: doc_id, score (0 to 1), window_start and window_end (words of the highest
    window). Null texts, empty texts and texts without words score 0 and have no window; without a model
    all scores are 0. Equal texts score alike; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Network | None = shared.value
        for batch in A.slices(batches, "text", SLICE):
            n = batch.num_rows
            p, first, last, none = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
            if net is not None:
                best, top, (start, length, _) = net.row_logits(*(words := read_words(batch.column(1))))
                p = net.probability(best.astype(np.float64))
                none = top < 0
                at = np.flatnonzero(~none)
                first[at] = start[top[at]] - words[2][:-1][at]
                last[at] = first[at] + length[top[at]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(first, mask=none), pa.array(last, mask=none)], ["doc_id", "score", "window_start", "window_end"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, window_start long, window_end long")

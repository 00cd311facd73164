"""Numpy views of Arrow text columns: words, fingerprints of spans, minimisers.

All of it is vectorised over a whole Arrow batch; no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_tables: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (bijective)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64))


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows so that each piece has about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offs = column_bytes(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def ascii_lower(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((BASE, _INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _tables[i] = np.cumprod(steps)
    return _tables[0], _tables[1]


class Prefix:
    """Polynomial prefix sums over symbols; ``spans`` gives a fingerprint of any range in constant time."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        powers, self.inverse = _powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, U64)
        np.cumsum(symbols * powers[: self.n], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def windows(self, width: int) -> np.ndarray:
        """Fingerprints of all ranges of ``width`` symbols."""
        count = max(0, self.n - width + 1)
        return mix((self.sums[width : width + count] - self.sums[:count]) * self.inverse[:count])


def byte_prefix(buf: np.ndarray) -> Prefix:
    return Prefix(_BYTE[buf])


@dataclass
class Words:
    """Words of a batch: byte ranges, fingerprints, and the offsets of each row's words."""

    start: np.ndarray
    end: np.ndarray
    value: np.ndarray
    offs: np.ndarray


def word_ranges(buf: np.ndarray, offs: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the maximal runs of non-separators, and each row's word offsets."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    gap = space[buf]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    inner = offs[(offs > 0) & (offs < n)]
    before[inner] = True
    after[inner - 1] = True
    start = np.flatnonzero(before & ~gap)
    end = np.flatnonzero(after & ~gap) + 1
    return start, end, np.searchsorted(start, offs)


def words(buf: np.ndarray, offs: np.ndarray) -> Words:
    """White-space separated words (bytes 9 to 13 and 32 separate)."""
    start, end, row_offs = word_ranges(buf, offs)
    value = byte_prefix(buf).spans(start, end) if len(start) else np.zeros(0, U64)
    return Words(start, end, value, row_offs)


def row_of(offs: np.ndarray) -> np.ndarray:
    """Row number of each element, from row offsets."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


@dataclass
class Anchors:
    """Minimisers of all windows. Window starts ``first`` to ``last`` share the minimiser at ``at``."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    key: np.ndarray
    context: np.ndarray


def anchors(prefix: Prefix, offs: np.ndarray, window: int, k: int) -> Anchors:
    """For every window of ``window`` symbols inside one row, the k-gram with the smallest fingerprint.

    Equal windows choose the same k-gram at the same place (ties: the leftmost), so equal windows have
    equal ``key``. Neighbouring windows with one minimiser form a context; its fingerprint covers all
    symbols of these windows and the place of the minimiser in them.
    """
    n = prefix.n
    none = np.zeros(0, np.int64)
    if n < window:
        return Anchors(none, none, none, none, none.astype(U64), none.astype(U64))
    value = prefix.windows(k)
    bits = U64(max(20, int(n).bit_length()))
    low = value >> bits << bits | np.arange(len(value), dtype=U64)
    need, span = window - k + 1, 1
    while 2 * span <= need:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < need:
        low = np.minimum(low[: len(low) - (need - span)], low[need - span :])
    row = row_of(offs)
    inside = np.arange(n - window + 1) + window <= offs[1:][row[: n - window + 1]]
    j = np.flatnonzero(inside)
    if len(j) == 0:
        return Anchors(none, none, none, none, none.astype(U64), none.astype(U64))
    at = (low[j] & U64((1 << int(bits)) - 1)).astype(np.int64)
    new = np.empty(len(j), bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (j[1:] != j[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last, at = j[begin], j[np.append(begin[1:] - 1, len(j) - 1)], at[begin]
    context = mix(prefix.spans(first, last + window) + (at - first).astype(U64) * U64(BASE))
    return Anchors(at, first, last, row[first], mix(value[at]), context)

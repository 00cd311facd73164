"""Plain versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def _low(i):
    return -(1 << 63) if i is None else i


def dedup_bytes(rows, window=50):
    """rows: (doc_id, text). -> sorted (doc_id, n_bytes, n_removed, n_spans, sha)."""
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for j in range(len(b) - window + 1):
            s = b[j : j + window]
            least[s] = min(least.get(s, _low(i)), _low(i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for j in range(len(b) - window + 1):
            if least[b[j : j + window]] < _low(i):
                gone[j : j + window] = b"\x01" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, _sha(kept)))
    return sorted(out, key=str)


def dedup_words(rows, window=20):
    """rows: (doc_id, text), unique ids. -> sorted (doc_id, n_words, n_removed, sha)."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (_low(r[0]), r[1] is None, r[1] or "")):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            s = tuple(w[j : j + window])
            if s in seen:
                gone[j : j + window] = [True] * window
            seen.add(s)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), _sha(kept.encode())))
    return sorted(out, key=str)


def shingles(text, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def near_duplicates(rows, n=4):
    """-> sorted (doc_id, n_shingles, component_id, kept); unique ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            by[x].add(i)
    pairs = {p for ids in by.values() for p in combinations(sorted(ids), 2)}
    for a, b in pairs:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= 80 * (len(sets[a]) + len(sets[b]) - inter):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())

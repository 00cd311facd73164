"""Importance resampling: buckets against zlib, a plain version on odd rows, totals with and without head tables."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyloom.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [*w, *(a + " " + b for a, b in zip(w, w[1:]))]


def bucket(f, k):
    return zlib.crc32(f.encode()) % k


def plain(docs, target, percent, min_words, k):
    s, t = [0] * k, [0] * k
    for acc, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for f in features(x)[1]:
                acc[bucket(f, k)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + k) / ((s[b] + 1) * (sum(t) + k)))) for b in range(k)]
    rows = []
    for i, x in docs:
        n, f = features(x)
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g, k)] for g in f) // len(f) if f else 0
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    part = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    drawn = len(part) * percent // 100
    return sorted([(*r[:4], n + 1 if n < drawn else None) for n, r in enumerate(part)] + [(*r[:4], None) for r in rows if r[4] < min_words], key=str)


DOCS = [(1, None), (2, ""), (3, " ,-. "), (4, "The cat sat. The CAT sat!"), (5, "naïve Über 日本語のテキスト été"), (6, "x" * 70 + " tail " + "é" * 40 + " a"), (7, "cat"), (7, "cat"), (None, "the dog and the cat"),
        (8, "word " * 40000 + "end"), (9, "ß_a\0b\x7fc{d|e}f`g@h/i:j"), *[(i, f"alpha beta gamma{i % 7} delta{i} the cat sat on the mat " * 3) for i in range(20, 60)]]


def test_equals_plain_version(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).repartition(5)
    target = spark.createDataFrame([("the cat sat on the mat",), (None,), ("gamma3 delta",)], "text string")
    want = plain(DOCS, [r[0] for r in target.collect()], 40, 2, 500)
    for use_head in (True, False):
        got = I.resample(df, target, percent=40, min_words=2, n_buckets=500, use_head=use_head)
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert I.resample(df.where("false"), target).count() == 0
    assert sorted(map(tuple, I.resample(df, target.where("false"), percent=40, min_words=2, n_buckets=500).collect()), key=str) == plain(DOCS, [], 40, 2, 500)


def test_head_is_used_and_exact(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 3000) % 5000) for _ in range(20)]
    head = I.frequent(spark.createDataFrame([(x,) for x in texts], "text string").repartition(3))
    assert np.count_nonzero(head.low) > 500 and np.count_nonzero(head.pair >= 0) > 200
    s = I.words(pa.array(texts))
    assert (head.find(s) >= 0).mean() > 0.8
    for h in (head, I.empty_head()):
        one, first, two = I.buckets(s, h, I.N_BUCKETS)
        w = [x for t in texts for x in t.split()]
        assert one.tolist() == [bucket(x, I.N_BUCKETS) for x in w]
        assert two.tolist() == [bucket(w[i] + " " + w[i + 1], I.N_BUCKETS) for i in first.tolist()]


def test_crc_of_any_length():
    raw = np.frombuffer(bytes(range(256)) * 4, np.uint8)
    start = np.arange(0, 200)
    end = start + np.arange(200) * 3
    assert I.crc_run(raw, start, end).tolist() == [zlib.crc32(raw[a:b]) for a, b in zip(start, end)]
    state = I.spaced(I.crc_run(raw, start, start + 3))
    assert I.crc_run(raw, start, end, state).tolist() == [zlib.crc32(bytes(raw[a : a + 3]) + b" " + bytes(raw[a:b])) for a, b in zip(start, end)]

"""Hard negatives: exact products, mergeable heaps, the whole operator against brute force on odd rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import negatives as N


def test_strassen_is_exact():
    rng = np.random.default_rng(0)
    for m, k, n in ((1, 1, 1), (3, 64, 70), (65, 33, 129), (100, 17, 40), (64, 64, 64), (5, 0, 7), (0, 9, 3)):
        a, b = rng.integers(-(1 << 24), 1 << 24, (m, k)), rng.integers(-(1 << 24), 1 << 24, (k, n))
        assert (N.strassen(a, b, 4) == a @ b).all()
    big = np.full((40, 32), 1 << 28)  # sums of half products pass 2**63, the result doesn't
    assert (N.strassen(big, np.full((32, 40), (1 << 28)), 2) == 32 << 56).all()


def test_heaps_merge():
    rng = np.random.default_rng(1)
    s, ids = rng.integers(0, 6, (4, 300)), rng.permutation(300)
    fits = rng.random((4, 300)) < 0.7
    one, parts = N.Heaps(4, 7), N.Heaps(4, 7)
    one.add_tile(s, fits, ids, np.arange(4))
    for i in range(0, 300, 37):
        parts.add_tile(s[:, i : i + 37], fits[:, i : i + 37], ids[i : i + 37], np.arange(4))
    for h in (one, parts):
        for r in range(4):
            want = sorted(((-s[r, j], ids[j]) for j in range(300) if fits[r, j]))[:7]
            assert [(-x, i) for x, i in zip(h.score[h.row == r], h.id[h.row == r])] == want


def plain(rows, n_pos=5, n_neg=10, low=30, high=90):
    ok = []
    for i, lab, v in rows:
        if None in (i, lab, v) or any(x is None or not math.isfinite(x) or abs(256 * x) > math.sqrt(2**56 / max(1, len(v))) - 1 for x in v):
            continue
        ok.append((i, lab, tuple(math.floor(256 * x) for x in v), v))
    anchors = {}
    for r in sorted((r for r in ok if r[0] % 100 == 0), key=lambda r: (r[0], r[1], r[3])):
        anchors.setdefault(r[0], r)
    out = []
    for a in anchors.values():
        score = [(sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in ok if r[0] != a[0]]
        for p, pid, _ in sorted((s for s in score if s[2] == a[1]), key=lambda s: (-s[0], s[1]))[:n_pos]:
            fit = sorted((s for s in score if s[2] != a[1] and low * p <= 100 * s[0] <= high * p), key=lambda s: (-s[0], s[1]))[:n_neg]
            out += [(a[0], pid, n + 1, s[1], p, s[0]) for n, s in enumerate(fit)]
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(size=12)]) for i in range(-50, 700)]
    hot = [0.5] * 12
    rows += [(1000 + i, i % 2, hot) for i in range(300)]  # ties: one vector many times
    rows += [(1, 0, rows[51][2]), (100, 1, hot), (100, 1, hot), (100, 2, hot), (None, 1, hot), (2001, None, hot), (2002, 1, None), (2003, 1, [None] * 12), (2100, 1, [float("nan")] * 12), (2200, 1, [float("inf")] * 12),
             (2300, 1, [1e300] * 12), (2400, 1, []), (2500, 0, [1.0, 2.0]), (2600, 1, [0.25] * 40), (2700, 1, [0.0] * 12), (2800, 77, hot), (2901, 2, [-1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("g", F.lit(0)).repartition(6)
    want = plain(rows)
    anchors = df.where(F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, N.mine(df, anchors).collect())) == want and len(want) > 500
    for name, n in (("LEAST", 64), ("TILE", 32), ("ANCHOR_TILE", 2), ("ANCHORS", 3)):  # many groups and tiles
        monkeypatch.setattr(N, name, n)
    assert sorted(map(tuple, N.mine(df, anchors).collect())) == want
    assert N.mine(df.where("false"), anchors).count() == 0 and N.mine(df, anchors.where("false")).count() == 0

"""Toxicity: gradients, held-out results, whole texts and odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyloom.llm import toxicity
from tallyloom.llm.queries import QUERIES


def test_gradients():
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    vocab, number, offs = toxicity.read_words(pa.array(["one two three four one two five " * 6, "six two seven"]))
    start, length, row = toxicity.windows(offs)
    ids, mask = toxicity.window_ids(start, length, number)
    y = np.array([1.0, 0.0])[row]

    def loss():
        q = toxicity.sigmoid(net.forward(net.inputs(vocab), ids, mask))
        return -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()

    g, rng = net.gradients(vocab, ids, mask, y), np.random.default_rng(0)
    for name, grad in g.items():
        way = rng.normal(size=grad.shape)
        base, eps = net.p[name], 1e-3
        net.p[name] = base + eps * way
        up = loss()
        net.p[name] = base - eps * way
        slope = (up - loss()) / (2 * eps)
        net.p[name] = base
        assert abs(slope - (grad * way).sum()) < 2e-3 * max(0.05, abs(slope)), name


def test_windows_cover_whole_rows():
    offs = np.cumsum([0, 0, 1, 31, 32, 33, 48, 49, 1000])
    start, length, row = toxicity.windows(offs)
    for r in range(8):
        seen = set()
        for s, n in zip(start[row == r], length[row == r]):
            seen |= set(range(s, s + n))
        assert seen == set(range(offs[r], offs[r + 1]))


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op9_bigru_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").toPandas()
    assert len(got) == 10000 and got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    held = got[got["held_out"] & got["toxic"].notna()]
    hit = held[held["toxic"] == 1]["predicted"].mean()
    wrong = held[held["toxic"] == 0]["predicted"].mean()
    assert hit > 0.88 and wrong < 0.02, (hit, wrong)  # about 350 toxic rows to learn from


def test_odd_rows(spark):
    bad = ["you are an awful stinker and " + w for w in "abcdefgh"]
    good = ["we saw the lovely garden near " + w for w in "abcdefgh"]
    net = toxicity.fit(bad * 20 + good * 20, np.repeat([1, 0], 160), 0.5, epochs=4)
    rows = [(1, None), (2, ""), (3, "--- !!"), (4, "lovely garden " * 30000 + "awful stinker"), (5, "lovely garden"), (5, "lovely garden"), (None, "awful stinker")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    got = [(r["doc_id"], round(r["score"], 6), r["window_end"]) for r in toxicity.score(df, net).collect()]
    by = {i: s for i, s, _ in got}
    assert len(got) == 7 and by[1] == by[2] == by[3] == 0 and by[5] < 0.5 < by[None]
    assert by[4] > 0.5 and [e for i, _, e in got if i == 4] == [60002]
    assert toxicity.score(df.where("false"), net).count() == 0
    assert {r["score"] for r in toxicity.score(df, None).collect()} == {0.0}
    assert toxicity.fit(["a"], np.array([1]), 0.5) is None

"""Host rules: counts against a plain version, the beta prior, a bad host, a small host, odd rows."""

import re

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import hostrules as H

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_of_odd_texts(spark):
    rng = np.random.default_rng(0)
    texts = [None, "", "\n\n \n", "a", "a\na\n a\na ", "#*$%&|<> é日本", " x y\x85z", "a b c d e a b c d e", "a b c d e f a b c d e", "x x x x x x", "x x x x x", "\r\nline\r\nline\r\n", "long " * 3000]
    texts += [" ".join(rng.choice(list("abc"), 60)) + "\n" * int(rng.integers(0, 3)) + "z" for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in H.count_texts(df, {"doc_id": F.col("doc_id")}).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_beta_prior_recovers_spread():
    rng = np.random.default_rng(1)
    n = rng.integers(5, 200, 4000)
    k = rng.binomial(n, rng.beta(2.0, 8.0, 4000))
    mean, strength = H.beta_prior(len(n), n.sum(), (n * n).sum(), k.sum(), (k * k / n).sum())
    assert abs(mean - 0.2) < 0.01 and abs(strength - 10) < 1.5
    assert H.beta_prior(0, 0.0, 0.0, 0.0, 0.0)[0] == 0 and H.beta_prior(1, 9.0, 81.0, 3.0, 1.0)[1] > 1e5


GOOD = "the quick brown fox jumps over a lazy dog near one wide river bank today"


def test_verdicts(spark):
    rows = [(i, GOOD, f"https://Good{i % 9}.org/p?{i}") for i in range(900)]
    rows += [(1000 + i, GOOD if i % 10 < 3 else "buy now", "bad.com") for i in range(200)]  # 70 % of its rows fail
    rows += [(2000, "buy", "small.net"), (2001, GOOD, "small.net")]  # half, but two rows only
    rows += [(3000, "#" + " | # ".join(GOOD.split()), None), (3001, GOOD, None), (3002, GOOD, ""), (None, GOOD, "good1.org"), (7, GOOD, "http://good7.org"), (7, GOOD, "http://good7.org")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit("clash")).withColumn("kept", F.lit(0)).withColumn("n", F.lit(0)).repartition(4)
    got = H.judge(df).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["host"]): (r["base_failed"], r["kept"]) for r in got}
    assert by[1000, "bad.com"] == (False, False) and by[1005, "bad.com"] == (True, False)
    assert by[2001, "small.net"] == (False, True) and by[2000, "small.net"] == (True, False)
    assert by[3, "good3.org"] == (False, True) and by[3000, None] == (False, True) and by[3002, ""] == (False, True)
    assert sum(r["kept"] for r in got) == 900 + 1 + 6
    assert H.judge(df.where("false")).count() == 0
    none = H.judge(df.drop("source"))
    assert {r["host"] for r in none.collect()} == {None} and none.where("kept AND base_failed OR NOT kept AND NOT base_failed").count() == 0


def test_every_host_cold_or_hot(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id AS doc_id", f"CASE WHEN id % 7 = 0 THEN '{GOOD}' ELSE 'few words' END AS text", "CASE WHEN id % 7 = 0 AND id % 2 = 0 THEN 'x.org' ELSE concat('h', id % 50) END AS source")
    want = sorted(map(tuple, H.judge(df).collect()))
    monkeypatch.setattr(H, "HOT", 1)
    assert sorted(map(tuple, H.judge(df).collect())) == want
    assert sum(r[7] for r in want) > 0

"""Decontamination: exact and edited copies, exact alignment scores, clean and odd rows."""

import random

import numpy as np
import pytest

from tallyloom.llm import decontam
from tallyloom.llm.queries import QUERIES


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_is_exact():
    rng = np.random.default_rng(4)
    pairs = [(rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64) + 10, rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64) + 10) for _ in range(60)]
    n_a, n_b = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    a, b = np.full((60, n_a.max()), 1, np.uint64), np.full((60, n_b.max()), 2, np.uint64)
    for i, (x, y) in enumerate(pairs):
        a[i, : len(x)], b[i, : len(y)] = x, y
    assert decontam.align(a, n_a, b, n_b)[0].tolist() == [smith_waterman(x, y) for x, y in pairs]


def test_planted_copies(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(30)).capitalize() + ".") for i in range(20)]
    docs, want = [], set()
    for d in range(120):
        text = [word() for _ in range(rnd.randint(0, 300))]
        if d % 3 == 0:
            i, copy = d % 20, items[d % 20][1].split()
            if d % 2:
                for _ in range(4):
                    copy[rnd.randint(0, 29)] = word()
                del copy[rnd.randint(0, 25)]
                copy.insert(10, word())
            at = rnd.randint(0, len(text))
            text[at:at] = [w.upper() for w in copy]
            want.add((d, i))
        docs.append((d, " ".join(text)))
    docs += [(500, None), (501, ""), (502, "x " * 40000), (None, items[0][1]), (503, items[1][1]), (503, items[1][1])]
    want |= {(None, 0), (503, 1)}
    items += [(90, None), (91, ""), (92, "x x"), (93, items[2][1])]
    want |= {(d, 93) for d, i in want if i == 2}
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS item_id")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS doc_id")
    got = decontam.find_leaks(df, bench).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted(want, key=str)
    assert decontam.find_leaks(df.where("false"), bench).count() == 0
    assert decontam.find_leaks(df, bench.where("false")).count() == 0


@pytest.mark.parametrize("blocks", [1, 3])
def test_table(spark, monkeypatch, blocks):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    if blocks > 1:
        monkeypatch.setattr(decontam, "BLOCK_WORDS", 500)
    rows = QUERIES["op1_seed_align_decontamination"](spark, sf).collect()
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows}
    exact = {(d["doc_id"], b["item_id"]) for d in docs for b in bench if b["text"].lower() in d["text"].lower()}
    assert exact and all(got[p] == 1.0 for p in exact)
    assert len(rows) == len(got) <= len(exact) + 3


def test_edited_copies_in_a_hot_group_beside_a_clean_one(spark):
    item = [f"item{i}" for i in range(38)]
    edited = [f"other{i}" if i % 4 == 3 else w for i, w in enumerate(item)]
    docs = [(d, " ".join([f"pad{d}"] * 5 + edited + [f"end{d}"] * 5)) for d in range(300)]
    docs += [(500, " ".join(item)), (501, "item0 item1 item2 item3 and no more of it")]
    got = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert {r["doc_id"]: r["score"] > 0.6 for r in got} == {d: True for d in [*range(300), 500]} and len(got) == 301


def test_one_seed_is_enough(spark):
    item = [f"item{i}" for i in range(15)]
    edited = [f"other{i}" if i in (2, 5, 8, 11) else w for i, w in enumerate(item)]
    apart = item[:4] + [f"new{i}" for i in range(5)] + item[4:]  # words put in between
    docs = [(1, " ".join(["before"] * 9 + edited + ["after"] * 9)), (2, " ".join(apart)), (3, "item0 item1 item2 " * 3)]
    got = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], round(r["score"], 4)) for r in got) == [(1, 0.6), (2, round(25 / 30, 4))]


def test_no_rows_are_made_in_python(spark):
    """Rows from a Python list would start a second set of Python workers beside those of the Arrow steps."""
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    for items in (bench, bench.where("false")):
        out = decontam.find_leaks(spark.range(1).selectExpr("id AS doc_id", "'x' AS text"), items)
        assert "ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.schema.simpleString() == "struct<doc_id:bigint,item_id:bigint,score:double,first_word:bigint,last_word:bigint,n_seeds:int>"
    assert decontam.find_leaks(docs, bench.where("false")).count() == 0

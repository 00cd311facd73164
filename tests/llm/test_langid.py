"""Language ID: held-out accuracy, exact Viterbi, mixed text, scripts and odd rows."""

from itertools import product

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import langid
from tallyloom.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op2_script_viterbi_langid"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.count() == 1000
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_viterbi_is_exact():
    rng = np.random.default_rng(1)
    length = [0, 5, 1, 6, 3, 0, 6]
    offs = np.append(0, np.cumsum(length))
    scores = rng.normal(size=(offs[-1], 3)).astype(np.float32)
    labels = langid.viterbi(scores, offs, 1.2)

    def value(s, path):
        return sum(s[i, p] for i, p in enumerate(path)) - 1.2 * sum(a != b for a, b in zip(path, path[1:]))

    for s, e in zip(offs, offs[1:]):
        if e > s:
            best = max(value(scores[s:e], p) for p in product(range(3), repeat=e - s))
            assert abs(value(scores[s:e], labels[s:e]) - best) < 1e-5


def model_of(spark):
    rows = [("the cat and the dog were in the house with their friends", "en"), ("der hund und die katze waren mit ihren freunden im haus", "de"), ("кошка и собака были в доме с друзьями", "ru")] * 20
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_of_mixed_text(spark):
    model = model_of(spark)
    text = "the dog and the cat with their friends " * 3 + "der hund und die katze mit ihren freunden " * 3 + "собака и кошка"
    r = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [(s["lang"], s["first"], s["last"]) for s in r["spans"]] == [("en", 0, 23), ("de", 24, 47), ("ru", 48, 50)]


def test_odd_rows(spark):
    model = model_of(spark)
    rows = [(1, None), (2, ""), (3, "123 -- %% ×÷ “”"), (4, "the house"), (4, "the house"), (None, "кошка"), (6, "ელ日本語"), (7, "the dog " * 60000), (8, "¡the!cat?")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit("y"))
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(df, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "ru"), (7, "en"), (8, "en")} <= got
    assert dict(x for x in got if x[0] == 6)[6] != "und"
    assert langid.identify(df.where("false"), model).count() == 0
    empty = langid.train(spark.createDataFrame([("x", None), (None, "en")], "text string, lang string"))
    assert {r["lang_pred"] for r in langid.identify(df, empty).collect()} == {"und"}

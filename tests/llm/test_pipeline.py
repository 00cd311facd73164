"""The pipeline's stages on planted cases, each on its predecessor's result."""

import random

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))


def test_stages(spark, shared, tmp_path):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("bcdfgl") + rnd.choice("aeiou") for _ in range(3))
    text = lambda n: " ".join(word() for _ in range(n))
    item, passage, base = text(30), text(60), text(200)
    near = base.split()
    near[50] = near[120] = "changed"
    rows = [(0, base), (1, base), (2, " ".join(near)), (3, None), (4, "12 34 !!"), (5, text(40) + " " + passage), (6, passage + " " + text(40)), (7, text(50) + " " + item + " " + text(50)), (8, text(80)), (9, "")]
    rows = [(i, t, "en", "s", len(t) if t else 0) for i, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, ids = docs.columns, []
    texts = {}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < 4:
            assert out.columns == columns and out.dtypes == docs.dtypes
            out.write.parquet(f"{tmp_path}/{i}")
            docs = spark.read.parquet(f"{tmp_path}/{i}")
            texts[i] = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
            ids.append(sorted(texts[i]))
    assert ids == [[0, 1, 2, 5, 6, 7, 8], [0, 5, 6, 7, 8], [0, 5, 6, 7, 8], [0, 5, 6, 8]]
    assert texts[3][8] == texts[0][8] and texts[3][6][0] == " ".join(texts[0][6][0].split()[60:]) and texts[3][6][1] == len(texts[3][6][0])
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 5, 6, 8]


def test_stages_on_the_table(spark, shared):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    (_, lang), (_, near), (_, cut), (_, leaks), _ = corpus_pipeline.STAGES
    a = lang(spark, docs, sf).cache()
    assert a.count() >= 0.97 * docs.count()
    kept = {r[0] for r in brute.near_duplicates([(r["doc_id"], r["text"]) for r in a.collect()], 5) if r[3]}
    b = near(spark, a, sf).cache()
    assert {r["doc_id"] for r in b.collect()} == kept
    c = cut(spark, b, sf).cache()
    want = {r[0]: r[3] for r in brute.dedup_words([(r["doc_id"], r["text"]) for r in b.collect()])}
    assert {r["doc_id"]: brute._sha(" ".join(brute.WORD.findall(r["text"])).encode()) for r in c.collect()} == want
    d = leaks(spark, c, sf)
    gone = {r["doc_id"] for r in c.collect()} - {r["doc_id"] for r in d.collect()}
    items = [r["text"].lower() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    exact = {r["doc_id"] for r in c.collect() if any(i in r["text"].lower() for i in items)}
    assert exact <= gone and len(gone) <= len(exact) + 3
    got = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == {r["doc_id"] for r in d.collect()}
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_empty_table(spark, shared):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0


def test_texts_are_not_sent_to_meet_few_leaks(spark, shared):
    sf = "/root/testdata/sf0.001"
    name, least = "spark.sql.autoBroadcastJoinThreshold", "40k"  # less than the documents, more than the ids
    was = spark.conf.get(name)
    spark.conf.set(name, least)
    try:
        out = corpus_pipeline.benchmark_leaks(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, was)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan

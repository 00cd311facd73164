"""Queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import ann, debruijn, decontam, hostrules, importance, langid, minhash, negatives, packing, shards, sql, suffix_dedup, toxicity, urlrules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_prefix_sum_shards": sql.SHARDS, "op5_suffix_array_dedup": sql.SUFFIXES, "op7_debruijn_dedup": sql.WORD_WINDOWS, "op10_circulant_minhash": sql.NEAR_DUPLICATES,
    "op11_head_tail_resampling": sql.RESAMPLED, "op12_strassen_negatives": sql.NEGATIVES, "op13_host_beta_rules": sql.HOST_RULES}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_seed_align_decontamination(spark, sf_dir):
    return decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op3_prefix_sum_shards(spark, sf_dir):
    plan = shards.plan_shards(read(spark, sf_dir, "documents"), 40)
    return plan.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.dedup_bytes(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op6_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urlrules.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
ORACLES["op6_url_rules"] = f"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw, rest FROM p),
u AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(substr(rest, length(raw) + 1), ''), '^[^?#]*') AS path, row_number() OVER () AS id FROM h),
r(rule_host, rule_path, action) AS (VALUES {_RULES_SQL}),
m AS (
  SELECT u.*, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY id ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST, length(rule_host) DESC) AS n
  FROM u LEFT JOIN r ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE n = 1
"""


@query
def op7_debruijn_dedup(spark, sf_dir):
    return debruijn.dedup_words(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op10_circulant_minhash(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), width=4, percent=80)


TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query
def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def crc(column: str, n: int):
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(n))


@query
def op2_script_viterbi_langid(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs.where(crc("doc_id", 4) != 2))
    return langid.identify(docs, model).select("doc_id", F.coalesce(crc("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query
def op9_bigru_toxicity(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(crc("doc_id", 5) != 0))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(crc("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_adaptive_dimension_ann(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query
def op11_head_tail_resampling(spark, sf_dir):
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=25, min_words=20, seed=7)


@query
def op12_strassen_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    rows = read(spark, sf_dir, "embeddings").select("vec_id", label, "embedding")
    return negatives.mine(rows, rows.where(F.col("vec_id") % 100 == 0))


@query
def op13_host_beta_rules(spark, sf_dir):
    return hostrules.judge(read(spark, sf_dir, "documents"))

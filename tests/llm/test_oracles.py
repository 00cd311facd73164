"""Corpus queries against their SQL, whole shards, and odd rows of the native operators."""

import zlib
from collections import defaultdict

import oracle
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import shards, urlrules
from tallyloom.llm.queries import ORACLES, QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_shards_of_odd_rows(spark):
    rows = [(i % 7 if i % 5 else None, "x" * (i % 90) if i % 11 else None) for i in range(2000)] + [(3, "y" * 5000)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("z")).withColumn("_part", F.lit(1))
    got = shards.plan_shards(df, 9).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted((i or -1, len(t or "") + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    total, start = sum(r["size"] for r in got), 0
    for s in range(9):
        part = sorted(by[s], key=lambda r: r["slot"])
        assert [r["slot"] for r in part] == list(range(len(part)))
        for r in part:
            assert r["start"] == start
            start += r["size"]
        assert abs(sum(r["size"] for r in part) - total / 9) <= 5016
    assert start == total
    assert shards.plan_shards(df.where("false"), 9).count() == 0


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, "t" * i) for i in range(50)], "doc_id long, text string")
    plan = shards.plan_shards(df, 4)
    shards.write_shards(df, plan, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


def judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fit = [(len(h) + len(p), len(h), h, p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda f: (f[0], f[1], f[4]), default=None)
    return host, path, best and best[2] + best[3], best[4] if best else default


def test_urls(spark):
    rules = [*URL_RULES, ("example.org", "/es/shop", "allow"), ("a.example.org", "/", "block"), ("a.example.org", "/e", "allow"), ("org", "/en", "allow"), ("org", "/en", "block"), ("exa-mple.org", "/", "block"), ("com", "", "block"), ("net", "/é", "block")]
    urls = [None, "", "nothing", "://", "http://", "HTTP://EXAMPLE.org", "http://example.org/", "http://example.org?x=/es/", "http://example.org/es/", "http://www.Example.ORG/es/shop?a", "http://example.org/es", "https://a.example.org/en/1#x",
            "https://b.a.example.org/", "https://xexample.org/en/1", "https://exa-mple.org/en/12", "http://example.org:80/es/", "https://a.com/fr/x", "https://a.com/de/", "https://a.com", "http://org/x", "http://com/fr/", "x://y://z/es/", "http://a.net/é?", "http://a.net/éa/b", "http://a.net/e", "http://.org/en/1", "http://example.org./es/", "http://example.org/es/#://"]
    rows = [(i % 20, u) for i, u in enumerate(urls + urls[:5])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("old")).withColumn("host", F.lit(1))
    got = urlrules.judge_urls(df, spark.createDataFrame(rules, "host string, path string, action string"))
    assert sorted((tuple(r) for r in got.select("page_id", "url", "host", "path", "rule", "verdict").collect()), key=str) == sorted(((i, u, *judge(u, rules)) for i, u in rows), key=str)
    none = spark.createDataFrame([], "host string, path string, action string")
    assert {r["verdict"] for r in urlrules.judge_urls(df, none, "block").collect()} == {"block"}
    assert urlrules.judge_urls(df.where("false"), none).count() == 0


def test_one_host_has_most_urls(spark):
    df = spark.range(3000).selectExpr("id AS page_id", "concat('https://', CASE WHEN id % 3 < 2 THEN 'www.example.org' ELSE concat('h', id, '.com') END, CASE id % 4 WHEN 0 THEN '/en/1' WHEN 1 THEN '/es/' WHEN 2 THEN '/fr/' ELSE '/de/' END, id) AS url")
    got = urlrules.judge_urls(df, spark.createDataFrame(URL_RULES, "host string, path string, action string")).collect()
    assert len(got) == 3000 and all((r["host"], r["path"], r["rule"], r["verdict"]) == judge(r["url"], URL_RULES) for r in got)

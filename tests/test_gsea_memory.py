"""Enrichment holds the scores of a cluster once in a task, and no table of sets by genes."""

import tracemalloc

import numpy as np

from tallyloom.operators import gsea


def test_levels_need_no_table_of_sets_by_genes():
    rng = np.random.default_rng(2)
    w = np.abs(rng.normal(size=300_000))
    tracemalloc.start()
    p, level = gsea.split_levels(w, 10, np.array([0.8]), rng)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < p[0] < 0.05 and level[0] > 0
    assert peak < 8e6  # 101 sets by 300,000 genes would be 30 MB


def test_scores_are_sent_once_for_all_jobs(spark):
    ranks = spark.range(4000).selectExpr("concat('c', id % 2) AS cluster", "concat('g', id) AS symbol", "sin(id) AS stat")
    sizes = spark.range(5, 45).selectExpr("'c0' AS cluster", "id AS size")
    out = gsea.null_scores(ranks, sizes, 400, 100)
    per = out.groupBy("cluster", "size").count().collect()
    assert len(per) == 40 and {r["count"] for r in per} == {400}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan

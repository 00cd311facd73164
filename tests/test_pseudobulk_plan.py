"""The pseudobulk table is worked out once, whatever number of branches read it."""

import pytest

from tallyloom.operators import joins
from tallyloom.workloads import QUERIES


@pytest.mark.parametrize("name", ["log_cpm_dense", "pseudobulk_dense", "welch_markers", "marker_means"])
def test_counts_are_read_once(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan


def test_filled_tables_are_not_sent(spark):
    rows = [("g1", "a", 1, 5, 2.0), ("g1", "b", 1, 7, None), ("g2", "a", 2, 1, 1.0), (None, "a", 1, 3, 3.0), ("g3", None, 1, 4, 4.0)]
    df = spark.createDataFrame(rows, "gene_id string, cluster string, batch long, count long, x double")
    out = joins.complete(df, ["gene_id"], ["cluster", "batch"], {"count": 0})
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {tuple(r) for r in out.collect()}
    cols = [("a", 1), ("b", 1), ("a", 2), (None, 1)]
    have = {r[:3]: r[3:] for r in rows if r[0] and r[1]}  # a null key meets nothing
    assert got == {(g, *c, *have.get((g, *c), (0, None))) for g in ("g1", "g2", "g3", None) for c in cols}
    ids = spark.createDataFrame([("g1",), ("new",)], "gene_id string")
    more = joins.complete(df, ["gene_id"], ["cluster", "batch"], {"count": 0}, row_values=ids)
    assert {r["gene_id"] for r in more.collect()} == {"g1", "new"} and more.count() == 8
    assert joins.complete(df.where("false"), ["gene_id"], ["cluster", "batch"], {"count": 0}).count() == 0

"""The queries of all lists never pass through the driver, however few bytes the queries themselves have."""

import numpy as np

from tallyloom.llm import ann


def test_queries_are_not_broadcast(spark):
    x = np.random.default_rng(3).normal(size=(3000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = ann.search(df, df.where("vec_id % 100 = 0"))
    assert len(out.collect()) == 300
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan

"""Bucketed counts: moments and clipped sums without an exchange of the counts."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import counts as C
from tallyloom.sources import sinks


@pytest.fixture
def tables(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("'b' || (id % 3 * (id % 2)) batch", "id % 400 cell_id", "id % 37 gene_id", "array('S', 'U')[id % 2] splice", "CAST(id % 5 AS DOUBLE) count")
    name = f"t_{uuid.uuid4().hex}"
    yield rows, sinks.write_bucketed_counts(rows, name, str(tmp_path / "counts"), n_buckets=6)
    spark.sql(f"DROP TABLE {name}")


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)", df._jdf.queryExecution().executedPlan().toString())


def test_no_exchange_of_counts(spark, tables, tmp_path):
    rows, bucketed = tables
    n = spark.createDataFrame([("b0", 400), ("b1", 400), ("b2", 400)], "batch string, n_cells long")
    assert exchanges(C.gene_mean_var(C.sum_splice(rows, ("batch", "cell_id", "gene_id")), n))  # the pattern finds them
    mv = C.gene_mean_var(bucketed, n)
    assert exchanges(mv) == []
    mv.withColumn("clip_val", F.col("mean") + 1).write.parquet(str(tmp_path / "mv"))
    clips = spark.read.parquet(str(tmp_path / "mv"))
    assert exchanges(C.clipped_sums(bucketed, clips)) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # a sorted join: only the clips (a row per gene) move
        assert len(exchanges(C.clipped_sums(bucketed, clips))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_same_counts(spark, tables):
    rows, bucketed = tables
    want = C.sum_splice(rows, ("batch", "cell_id", "gene_id")).select(*bucketed.columns)
    assert bucketed.count() == want.count() and bucketed.exceptAll(want).count() == 0

"""Component spaces take all the variable genes of the stage, and sparse vectors give the components of dense ones."""

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import embed
from tallyloom.operators import counts as C
from tallyloom.plans import stages
from tallyloom.workloads import q_embed, roles

SF = "/root/testdata/sf0.01"


def test_genes_are_not_cut(spark):
    gs, cells = roles.gene_sums(spark, SF), roles.cells(spark, SF)
    there = gs.select("gene_id").distinct().count()
    assert there > 100 and q_embed._variable_genes(gs, cells).count() == min(stages.N_HVGS, there)


def test_sparse_components(spark):
    rng = np.random.default_rng(5)
    rows = [(c, g, float(1 + rng.poisson(9 if c % 3 == g % 3 else 1))) for c in range(120) for g in range(30) if rng.random() < 0.4]
    logs = C.log_normalise(df := spark.createDataFrame(rows, "cell_id long, gene_id long, count double"), C.library_sizes(df))
    genes, cells = spark.range(30).toDF("gene_id"), spark.range(125).toDF("cell_id")  # five cells have no counts
    want = embed.pca(embed.scaled_vectors(logs, genes, cells), 4)
    got = embed.components(logs, genes, cells, 4)
    both = got.join(want.withColumnRenamed("embedding", "e"), "cell_id").select(F.array_max(F.transform(F.arrays_zip("embedding", "e"), lambda x: F.abs(x["embedding"] - x["e"]))).alias("d"))
    assert both.count() == 125 and both.agg(F.max("d")).first()[0] < 1e-8

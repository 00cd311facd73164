"""Queries that read the counts in many branches join lines to orders once and go on from the written sums."""

import pytest

from tallyloom.workloads import QUERIES, roles

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["pca", "integration_cells", "doublet_scores", "hvg_counts", "hvg_rank_loess", "std_variance_linear"])
def test_counts_are_made_once(spark, monkeypatch, name):
    made, plain = [], roles.cell_counts
    monkeypatch.setattr(roles, "cell_counts", lambda *a: made.append(plain(*a)) or made[-1])
    out = QUERIES[name](spark, SF)
    assert out.count() > 0 and len(made) == 1
    assert "AS splice" not in out._jdf.queryExecution().analyzed().toString()  # counts are not worked out again

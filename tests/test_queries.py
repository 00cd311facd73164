"""Registered queries against their SQL on the smallest tables."""

import oracle
import pytest

from tallyloom.workloads import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# a cross-section of all query modules; the script oracle.py runs every one
NAMES = """splice_sum usa_totals gene_mean_var clipped_sums normalise_total gene_median_counts cell_qc_metrics filter_qc sample_qc_stats hvg_all_cells
barcode_ranks first_knee barcode_table tukey_outliers nearest_snap pseudobulk_sum pseudobulk_median log_cpm_dense marker_means norm_factors welch_markers bh_adjust
top_markers_tiered gsea_ranks majority_label confusion cluster_entropy cluster_relabel doublet_clusters classify_cells clr_tags tag_median_check ambient_loglik
knn_exact quantiles exclusion_sets mid_rank_nulls row_positions running_counts contained_names scalar_text scalar_numbers check_exclusion_list check_identical_tables""".split()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    assert len(rows) == 5 and {r["bad_batch"] for r in rows} <= {True, False}


def test_gsea_marks_main_pathways(spark):
    rows = QUERIES["gsea"](spark, SF).collect()
    main = {r["pathway"] for r in rows if r["main_path"]}
    assert main and min(r["pval"] for r in rows) < 1 / 201
    assert any(r["padj"] < 0.05 and not r["main_path"] for r in rows)  # one set inside another


def test_cleaned_counts_are_returned(spark):
    clean, share = QUERIES["decontaminated_counts"](spark, SF), QUERIES["decontaminate"](spark, SF)
    assert clean.select("run_id", "barcode").distinct().count() == share.count() > 0


def test_queries_run_the_operators_defaults(spark, monkeypatch):
    from tallyloom.operators import ambient, embed

    given = {}
    for module, name in ((ambient, "empty_drops"), (ambient, "decontaminate"), (embed, "batch_correct")):
        def call(*args, _real=getattr(module, name), _name=name, **kw):
            given[_name] = kw
            return _real(*args, **kw)
        monkeypatch.setattr(module, name, call)
        QUERIES[name](spark, SF)
    assert given == {"empty_drops": {}, "decontaminate": {}, "batch_correct": {}}

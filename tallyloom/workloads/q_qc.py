"""Quality-control queries."""

from pyspark.sql import functions as F

from tallyloom.operators import qc
from tallyloom.workloads import roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import QC, rnd


@query("cell_qc_metrics", QC + f""" SELECT batch, cell_id, sum, detected, subsets_mito_sum, subsets_mito_detected, total_spliced,
  total_unspliced, total_w_ribo, total_rrna, total_mt_rrna, sum AS total, {rnd('subsets_mito_sum / sum * 100')} AS subsets_mito_percent,
  {rnd('logit_spliced')} AS logit_spliced, {rnd('log_counts')} AS log_counts, {rnd('log_feats')} AS log_feats,
  {rnd('logit_mito')} AS logit_mito, {rnd('splice_ratio')} AS splice_ratio FROM m""")
def cell_qc_metrics(spark, sf):
    return rounded(roles.qc_cells(spark, sf))


@query("filter_qc", QC + " SELECT batch, cell_id, keep_hard, keep FROM f")
def filter_qc(spark, sf):
    return roles.filtered_cells(spark, sf).select("batch", "cell_id", "keep_hard", "keep")


@query("sample_qc_stats", QC + """, k AS (SELECT batch, COUNT(*) AS n_cells FROM f WHERE keep GROUP BY 1)
  SELECT batch, CAST(200 AS BIGINT) AS min_cells, coalesce(n_cells, 0) AS n_cells, coalesce(n_cells, 0) < 200 AS bad_qc, coalesce(n_cells, 0) < 200 AS bad_batch
  FROM (SELECT DISTINCT c_mktsegment AS batch FROM customer) LEFT JOIN k USING (batch)""")
def sample_qc_stats(spark, sf):
    return qc.sample_qc_stats(roles.filtered_cells(spark, sf), roles.cuts(spark, sf))

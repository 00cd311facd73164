"""Pseudobulk queries."""

from pyspark.sql import functions as F

from tallyloom.operators import counts as C
from tallyloom.operators import pseudobulk as P
from tallyloom.session import cut_lineage
from tallyloom.workloads import roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import PB, QC, rnd

MIN_CELLS = 5

OK = PB + f""", lib0 AS (SELECT cluster, batch, SUM(cnt) AS lib_size FROM pb GROUP BY 1, 2),
lib1 AS (SELECT cluster, batch, lib_size, n_cells, ln(lib_size) AS l FROM lib0 JOIN nc USING (cluster, batch) WHERE n_cells >= {MIN_CELLS}),
lib2 AS (SELECT *, median(l) OVER (PARTITION BY cluster) AS m FROM lib1),
lib3 AS (SELECT *, median(abs(l - m)) OVER (PARTITION BY cluster) * 1.4826 AS md FROM lib2),
ok AS (SELECT cluster, batch, lib_size, n_cells FROM lib3 WHERE NOT (l < m - 3 * md)),
lc AS (SELECT cluster, batch, gene_id, cnt, lib_size, n_cells, ln(cnt / lib_size * 1e6 + 10) AS logcpm FROM pb JOIN ok USING (cluster, batch))"""

DENSE = OK + """, gn AS (SELECT DISTINCT gene_id FROM lc),
dense AS (SELECT ok.cluster, ok.batch, gn.gene_id, coalesce(cnt, 0) AS cnt, ok.lib_size, ok.n_cells, ln(coalesce(cnt, 0) / ok.lib_size * 1e6 + 10) AS logcpm
  FROM ok CROSS JOIN gn LEFT JOIN pb ON pb.cluster = ok.cluster AND pb.batch = ok.batch AND pb.gene_id = gn.gene_id)"""

MEANS = DENSE + """, mn AS (SELECT cluster, gene_id, COUNT(*) AS n_samples, COUNT(CASE WHEN cnt > 0 THEN 1 END) AS n_nonzero, avg(logcpm) AS mean_logcpm,
  CASE WHEN COUNT(*) > 1 THEN var_samp(logcpm) END AS var_logcpm FROM dense GROUP BY 1, 2)"""


def base(spark, sf):
    """(gene_sums with cluster and batch, cells per cluster and batch)"""
    gs = C.sum_splice(roles.cell_counts(spark, sf)).join(roles.clustered_cells(spark, sf), "cell_id")
    n = roles.cells(spark, sf).select("cell_id").join(roles.clustered_cells(spark, sf), "cell_id")
    return gs, P.n_cells_by(n)


def pb_table(spark, sf):
    gs, n = base(spark, sf)
    n = cut_lineage(n)  # both feed many branches
    return cut_lineage(P.pseudobulk(gs, n)), n


@query("pseudobulk_sum", PB + f""" SELECT cluster, batch, gene_id, cnt AS count, n_det AS n_detected, n_cells, {rnd('cnt / n_cells')} AS mean,
  {rnd('n_det / n_cells')} AS prop_detected FROM pb JOIN nc USING (cluster, batch)""")
def pseudobulk_sum(spark, sf):
    return rounded(pb_table(spark, sf)[0])


@query("pseudobulk_median", PB + f""", gn AS (SELECT DISTINCT cluster, batch, gene_id FROM pb),
  ids AS (SELECT DISTINCT cluster, batch, cell_id FROM x)
  SELECT gn.cluster, gn.batch, gn.gene_id, {rnd('quantile_cont(coalesce(n, 0), 0.5)')} AS median FROM gn JOIN ids USING (cluster, batch)
  LEFT JOIN g ON g.cell_id = ids.cell_id AND g.gene_id = gn.gene_id GROUP BY 1, 2, 3""")
def pseudobulk_median(spark, sf):
    gs, n = base(spark, sf)
    return rounded(P.pseudobulk_median(gs, n))


@query("pseudobulk_dense", PB + """, gn AS (SELECT DISTINCT gene_id FROM pb), cb AS (SELECT DISTINCT cluster, batch FROM pb)
  SELECT cluster, batch, gene_id, coalesce(cnt, 0) AS count FROM gn CROSS JOIN cb LEFT JOIN pb USING (cluster, batch, gene_id)""")
def pseudobulk_dense(spark, sf):
    return P.complete_pseudobulk(pb_table(spark, sf)[0].select("cluster", "batch", "gene_id", "count"))


@query("pseudobulk_cells", QC + """, k AS (SELECT batch FROM f WHERE keep GROUP BY 1 HAVING COUNT(*) >= 200)
  SELECT f.batch, gene_id, SUM(n) AS count FROM f JOIN g USING (cell_id) WHERE keep AND f.batch IN (SELECT batch FROM k) GROUP BY 1, 2""")
def pseudobulk_cells(spark, sf):
    from tallyloom.operators import qc

    cells = roles.filtered_cells(spark, sf)
    status = qc.sample_qc_stats(cells, roles.cuts(spark, sf))
    return P.pseudobulk_cells(C.sum_splice(roles.cell_counts(spark, sf)), cells.where("keep"), status)


@query("n_cells_complete", PB + """, cs AS (SELECT DISTINCT cluster FROM nc), bs AS (SELECT DISTINCT batch FROM nc)
  SELECT cluster, batch, coalesce(n_cells, 0) AS n_cells FROM cs CROSS JOIN bs LEFT JOIN nc USING (cluster, batch)""")
def n_cells_complete(spark, sf):
    n = roles.cells(spark, sf).select("cell_id").join(roles.clustered_cells(spark, sf), "cell_id")
    return P.n_cells_by(n, complete=True)


@query("prop_detected", PB + f""" SELECT cluster, batch, gene_id, {rnd('n_det / n_cells')} AS prop, n_cells FROM pb JOIN nc USING (cluster, batch) WHERE n_cells >= {MIN_CELLS}""")
def prop_detected(spark, sf):
    return rounded(P.detection_props(pb_table(spark, sf)[0], min_cells=MIN_CELLS))


@query("mad_outliers", OK + f""" SELECT cluster, batch, lib_size, n_cells, l < m - 3 * md AS is_outlier FROM lib3""")
def mad_outliers(spark, sf):
    pb, n = pb_table(spark, sf)
    libs = P.sample_libraries(pb).join(n.where(F.col("n_cells") >= MIN_CELLS), ["cluster", "batch"])
    return P.mad_outliers(libs)


@query("log_cpm_raw", OK + f" SELECT cluster, batch, gene_id, cnt AS count, lib_size, n_cells, {rnd('logcpm')} AS logcpm FROM lc")
def log_cpm_raw(spark, sf):
    pb, n = pb_table(spark, sf)
    return rounded(P.log_cpm(pb, n, min_cells=MIN_CELLS))


@query("log_cpm_dense", DENSE + f" SELECT cluster, batch, gene_id, cnt AS count, lib_size, n_cells, {rnd('logcpm')} AS logcpm FROM dense")
def log_cpm_dense(spark, sf):
    pb, n = pb_table(spark, sf)
    return rounded(P.log_cpm(pb, n, min_cells=MIN_CELLS, zeros=True))


@query("mean_log_cpm", MEANS + f""" SELECT cluster, gene_id, n_samples, n_nonzero, {rnd('mean_logcpm')} AS mean_logcpm, {rnd('var_logcpm', 5)} AS var_logcpm
  FROM mn WHERE n_nonzero > 0""")
def mean_log_cpm(spark, sf):
    pb, n = pb_table(spark, sf)
    lc, ok = P.log_cpm(pb, n, min_cells=MIN_CELLS), P.usable_samples(pb, n, min_cells=MIN_CELLS)
    out = P.mean_log_cpm(lc, ok)
    return out.withColumns({"mean_logcpm": F.round("mean_logcpm", 6) + F.lit(0.0), "var_logcpm": F.round("var_logcpm", 5) + F.lit(0.0)})


@query("marker_means", MEANS + f""", tot AS (SELECT gene_id, SUM(n_samples * mean_logcpm) AS wx, SUM(n_samples) AS w FROM mn GROUP BY 1)
  SELECT cluster, gene_id, {rnd('mean_logcpm')} AS logcpm_sel, {rnd('(wx - n_samples * mean_logcpm) / (w - n_samples)')} AS logcpm_other
  FROM mn JOIN tot USING (gene_id) WHERE n_nonzero > 0""")
def marker_means(spark, sf):
    pb, n = pb_table(spark, sf)
    lc, ok = P.log_cpm(pb, n, min_cells=MIN_CELLS), P.usable_samples(pb, n, min_cells=MIN_CELLS)
    return rounded(P.selected_vs_other(P.mean_log_cpm(lc, ok), ok))


@query("zero_counts", MEANS + " SELECT cluster, gene_id, n_samples - n_nonzero AS n_zero, n_samples AS n_cl FROM mn WHERE n_nonzero > 0")
def zero_counts(spark, sf):
    pb, n = pb_table(spark, sf)
    return P.zero_counts(P.log_cpm(pb, n, min_cells=MIN_CELLS), P.usable_samples(pb, n, min_cells=MIN_CELLS))


@query("filter_by_expression", OK + """, need AS (SELECT CASE WHEN m > 10 THEN 10 + (m - 10) * 0.7 ELSE m END AS need FROM (SELECT min(k) AS m FROM (SELECT cluster, COUNT(*) AS k FROM ok GROUP BY 1))),
  cut AS (SELECT 1.0 / median(lib_size) * 1e6 AS cut FROM ok)
  SELECT gene_id FROM lc, need, cut GROUP BY gene_id, need HAVING COUNT(CASE WHEN cnt / lib_size * 1e6 >= cut THEN 1 END) >= need - 1e-14 AND SUM(cnt) >= 15""")
def filter_by_expression(spark, sf):
    pb, n = pb_table(spark, sf)
    return P.filter_by_expression(pb, P.usable_samples(pb, n, min_cells=MIN_CELLS))


@query("norm_factors", """WITH y AS (SELECT c_mktsegment AS batch, l_partkey AS gene_id, SUM(l_quantity) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
  gn AS (SELECT DISTINCT gene_id FROM y), lib AS (SELECT batch, SUM(y) AS lib FROM y GROUP BY 1),
  uq AS (SELECT lib.batch, lib, quantile_cont(coalesce(y.y, 0), 0.75) / lib AS f75 FROM lib CROSS JOIN gn LEFT JOIN y ON y.batch = lib.batch AND y.gene_id = gn.gene_id GROUP BY 1, 2),
  ref AS (SELECT batch AS rb, lib AS lr FROM uq ORDER BY round(abs(f75 - (SELECT avg(f75) FROM uq)), 12), batch LIMIT 1),
  j AS (SELECT a.batch, a.gene_id, a.y, lib, r.y AS yr, lr FROM y a JOIN lib USING (batch) CROSS JOIN ref JOIN y r ON r.batch = rb AND r.gene_id = a.gene_id),
  k AS (SELECT *, round(log2((y / lib) / (yr / lr)), 10) AS m, round((log2(y / lib) + log2(yr / lr)) / 2, 10) AS e,
    (lib - y) / lib / y + (lr - yr) / lr / yr AS v, COUNT(*) OVER (PARTITION BY batch) AS n FROM j),
  q AS (SELECT *, rank() OVER (PARTITION BY batch ORDER BY m) + (COUNT(*) OVER (PARTITION BY batch, m) - 1) / 2.0 AS rm,
    rank() OVER (PARTITION BY batch ORDER BY e) + (COUNT(*) OVER (PARTITION BY batch, e) - 1) / 2.0 AS re FROM k),
  f AS (SELECT batch, SUM(m / v) / SUM(1 / v) AS lf FROM q WHERE rm BETWEEN floor(n * 0.3) + 1 AND n - floor(n * 0.3)
    AND re BETWEEN floor(n * 0.05) + 1 AND n - floor(n * 0.05) AND v > 0 GROUP BY 1)
  SELECT batch, lib AS lib_size, """ + rnd("pow(2, lf - (SELECT avg(lf) FROM f))") + " AS norm_factor, " + rnd("lib * pow(2, lf - (SELECT avg(lf) FROM f))", 3) + " AS norm_lib_size FROM f JOIN lib USING (batch)")
def norm_factors(spark, sf):
    pb = C.sum_splice(roles.counts(spark, sf), ("batch", "gene_id"))
    out = P.norm_factors(pb, ["batch"])
    return out.withColumns({"norm_factor": F.round("norm_factor", 6) + F.lit(0.0), "norm_lib_size": F.round("norm_lib_size", 3) + F.lit(0.0)})


_VST = OK + """, ml AS (SELECT avg(lib_size) AS l, COUNT(*) AS n FROM ok),
  xs AS (SELECT gene_id, cnt / lib_size * l AS x, n FROM lc, ml),
  mo AS (SELECT gene_id, n, SUM(x) / n AS mean, (SUM(x * x) - n * (SUM(x) / n) * (SUM(x) / n)) / (n - 1) AS var FROM xs GROUP BY 1, 2),
  a AS (SELECT greatest(avg(greatest((var - mean) / (mean * mean), 0)), 1e-8) AS a FROM mo),
  t AS (SELECT gene_id, n, asinh(sqrt(a * x)) / sqrt(a) AS t FROM xs, a),
  vst AS (SELECT gene_id, SUM(t) / n AS vst_mean, (SUM(t * t) - n * (SUM(t) / n) * (SUM(t) / n)) / (n - 1) AS vst_var FROM t GROUP BY gene_id, n)"""


@query("pseudobulk_hvgs", _VST + f" SELECT gene_id, {rnd('vst_mean', 5)} AS vst_mean, {rnd('vst_var', 5)} AS vst_var FROM vst")
def pseudobulk_hvgs(spark, sf):
    pb, n = pb_table(spark, sf)
    return rounded(P.stabilised_variance(pb, P.usable_samples(pb, n, min_cells=MIN_CELLS)), 5)


@query("top_ambient_profile", _VST + """ SELECT gene_id, round(vst_mean, 5) + 0.0 AS vst_mean FROM vst ORDER BY round(vst_mean, 9) DESC, gene_id LIMIT 30""")
def top_ambient_profile(spark, sf):
    pb, n = pb_table(spark, sf)
    v = P.stabilised_variance(pb, P.usable_samples(pb, n, min_cells=MIN_CELLS))
    top = P.top_genes(v.withColumn("vst_mean", F.round("vst_mean", 9)), "vst_mean", 30)
    return rounded(top.select("gene_id", "vst_mean"), 5)


@query("dotplot_stats", OK + f""", sz AS (SELECT cluster, SUM(lib_size) AS lib_size, SUM(n_cells) AS n_cells FROM ok GROUP BY 1),
  d AS (SELECT cluster, gene_id, SUM(cnt) AS c, SUM(n_det) AS nd FROM pb JOIN ok USING (cluster, batch) GROUP BY 1, 2)
  SELECT cluster, gene_id, {rnd('c / lib_size * 1e6')} AS cpm, {rnd('log10(c / lib_size * 1e6 + 1)')} AS log10cpm, {rnd('nd / n_cells')} AS p_detect FROM d JOIN sz USING (cluster)""")
def dotplot_stats(spark, sf):
    pb, n = pb_table(spark, sf)
    return rounded(P.dotplot_stats(pb, P.usable_samples(pb, n, min_cells=MIN_CELLS)))

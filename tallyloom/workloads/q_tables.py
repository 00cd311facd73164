"""Join, reshape, window, set and scalar queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom import functions as S
from tallyloom.operators import counts as C
from tallyloom.operators import joins, labels, ordered, qc, reshape, summaries
from tallyloom.operators import pseudobulk as P
from tallyloom.workloads import roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import QC, X, rnd


@query("thresholds", """SELECT batch, CAST(CASE WHEN batch = 'BUILDING' THEN 700 ELSE 500 END AS BIGINT) AS min_counts, CAST(20 AS BIGINT) AS min_feats, CAST(0 AS DOUBLE) AS min_mito,
  CASE WHEN batch = 'MACHINERY' THEN 0.3 ELSE 0.25 END::DOUBLE AS max_mito, CAST(0 AS DOUBLE) AS min_splice, 0.6::DOUBLE AS max_splice, CAST(200 AS BIGINT) AS min_cells FROM (SELECT DISTINCT c_mktsegment AS batch FROM customer)""")
def thresholds(spark, sf):
    b = roles.cell_batches(spark, sf).select("batch").distinct()
    custom = b.where("batch IN ('BUILDING', 'MACHINERY')").select(
        "batch", F.when(F.col("batch") == "BUILDING", 700).alias("min_counts"), F.when(F.col("batch") == "MACHINERY", 0.3).alias("max_mito"))
    return qc.thresholds(b, roles.CUTS, custom)


@query("cuts_long", """WITH b AS (SELECT DISTINCT c_mktsegment AS batch FROM customer), v AS (SELECT * FROM (VALUES ('log_counts', log10(500), 'Infinity'::DOUBLE), ('log_feats', log10(20), 'Infinity'::DOUBLE),
  ('logit_mito', '-Infinity'::DOUBLE, ln(0.25::DOUBLE / (1 - 0.25::DOUBLE))), ('logit_spliced', '-Infinity'::DOUBLE, ln(0.6::DOUBLE / (1 - 0.6::DOUBLE))), ('n_cells', log10(200), 'Infinity'::DOUBLE)) t(qc_var, lo, hi))
  SELECT batch, qc_var, lo AS min, hi AS max FROM b, v""")
def cuts_long(spark, sf):
    return qc.cuts_long(roles.cuts(spark, sf))


_QL = """, l AS (SELECT batch, 'log_counts' AS qc_var, log_counts AS v FROM m UNION ALL SELECT batch, 'log_feats', log_feats FROM m
  UNION ALL SELECT batch, 'logit_mito', logit_mito FROM m UNION ALL SELECT batch, 'splice_ratio', splice_ratio FROM m)"""


@query("quantiles", QC + _QL + f""" SELECT batch, qc_var, {rnd('log10(COUNT(*))')} AS log10_n, {rnd('quantile_cont(v, 0.5)')} AS q50, {rnd('quantile_cont(v, 0.1)')} AS q10,
  {rnd('quantile_cont(v, 0.9)')} AS q90, {rnd('quantile_cont(v, 0.025)')} AS q025, {rnd('quantile_cont(v, 0.975)')} AS q975 FROM l GROUP BY 1, 2""")
def quantiles(spark, sf):
    return rounded(qc.quantile_summary(roles.qc_cells(spark, sf), ["log_counts", "log_feats", "logit_mito", "splice_ratio"]))


@query("qc_annotations", QC + f""", a AS (SELECT batch, log10(COUNT(*)) AS log_n, median(log_counts) AS mc, median(log_feats) AS mf, median(1 / (1 + exp(-logit_mito))) AS mm, median(1 / (1 + exp(-splice_ratio))) AS ms FROM m GROUP BY 1)
  SELECT m.batch, cell_id, {rnd('log_n')} AS log_n, {rnd('mc')} AS med_counts, {rnd('mf')} AS med_feats, {rnd('mm')} AS med_mito, {rnd('ms')} AS med_splice,
  CASE WHEN round(pow(10, log_n)) <= 100 THEN '<=100' WHEN round(pow(10, log_n)) <= 200 THEN '<=200' WHEN round(pow(10, log_n)) <= 400 THEN '<=400' WHEN round(pow(10, log_n)) <= 1000 THEN '<=1000' ELSE '<=2000' END AS n_cat,
  CASE WHEN pow(10, mc) <= 300 THEN '<=300' WHEN pow(10, mc) <= 1000 THEN '<=1000' ELSE '<=3000' END AS counts_cat,
  CASE WHEN pow(10, mf) <= 100 THEN '<=100' WHEN pow(10, mf) <= 300 THEN '<=300' ELSE '<=1000' END AS feats_cat,
  CASE WHEN mm <= 0.05 THEN '<=0.05' WHEN mm <= 0.1 THEN '<=0.1' WHEN mm <= 0.2 THEN '<=0.2' ELSE '<=0.5' END AS mito_cat,
  CASE WHEN ms <= 0.2 THEN '<=0.2' WHEN ms <= 0.5 THEN '<=0.5' ELSE '<=1' END AS splice_cat FROM m JOIN a USING (batch)""")
def qc_annotations(spark, sf):
    x = qc.annotate_batches(roles.qc_cells(spark, sf))
    return rounded(x.select("batch", "cell_id", "log_n", "med_counts", "med_feats", "med_mito", "med_splice", "n_cat", "counts_cat", "feats_cat", "mito_cat", "splice_cat"))


@query("qc_summary", QC + """, s AS (SELECT batch, COUNT(*) AS n_pre_qc, COUNT(CASE WHEN keep THEN 1 END) AS n_post_qc,
  round(COUNT(CASE WHEN sum < 500 THEN 1 END) / COUNT(*) * 100, 1) + 0.0 AS pct_excluded_by_log_counts, round(COUNT(CASE WHEN detected < 20 THEN 1 END) / COUNT(*) * 100, 1) + 0.0 AS pct_excluded_by_log_feats,
  round(COUNT(CASE WHEN logit_mito > ln(0.25 / 0.75) THEN 1 END) / COUNT(*) * 100, 1) + 0.0 AS pct_excluded_by_logit_mito,
  round(COUNT(CASE WHEN logit_spliced > ln(0.6 / (1 - 0.6)) THEN 1 END) / COUNT(*) * 100, 1) + 0.0 AS pct_excluded_by_logit_spliced FROM f GROUP BY 1)
  SELECT *, n_pre_qc - n_post_qc AS n_excluded, round(100 * (1 - n_post_qc / n_pre_qc), 1) + 0.0 AS pct_excluded, n_post_qc = 0 AS excluded FROM s""")
def qc_summary(spark, sf):
    return rounded(qc.qc_summary(roles.filtered_cells(spark, sf), roles.cuts(spark, sf)), 1)


@query("exclusion_sets", QC + """, e AS (SELECT CAST(log_counts + 1e-10 < log10(500) AS INTEGER) AS low_umis, CAST(log_feats + 1e-10 < log10(20) AS INTEGER) AS low_genes, 0 AS low_mito,
  CAST(logit_mito - 1e-10 > ln(0.25 / 0.75) AS INTEGER) AS high_mito, 0 AS low_spliced, CAST(logit_spliced - 1e-10 > ln(0.6 / (1 - 0.6)) AS INTEGER) AS high_spliced, CAST(keep AS INTEGER) AS passed_qc FROM f WHERE keep_hard)
  SELECT low_umis, low_genes, low_mito, high_mito, low_spliced, high_spliced, passed_qc, COUNT(*) AS n_cells FROM e GROUP BY ALL""")
def exclusion_sets(spark, sf):
    return qc.exclusion_sets(roles.filtered_cells(spark, sf), roles.cuts(spark, sf))


@query("metric_heatmap", QC + _QL + f""", md AS (SELECT batch, qc_var, median(v) AS mv FROM l GROUP BY 1, 2 UNION ALL SELECT batch, 'log10_n', log10(COUNT(*)) FROM m GROUP BY 1),
  z AS (SELECT *, (mv - avg(mv) OVER (PARTITION BY qc_var)) / stddev_samp(mv) OVER (PARTITION BY qc_var) AS z FROM md)
  SELECT batch, qc_var, {rnd('mv')} AS med_val, {rnd("CASE WHEN qc_var IN ('logit_mito', 'splice_ratio') THEN -z ELSE z END", 5)} AS z FROM z""")
def metric_heatmap(spark, sf):
    h = qc.metric_heatmap(roles.qc_cells(spark, sf))
    return h.select("batch", "qc_var", (F.round("med_val", 6) + F.lit(0.0)).alias("med_val"), (F.round("z", 5) + F.lit(0.0)).alias("z"))


@query("totals_by_metadata", QC + """, c AS (SELECT c_nationkey AS sid, COUNT(*) AS pre, COUNT(CASE WHEN keep THEN 1 END) AS post FROM f JOIN customer ON cell_id = c_custkey GROUP BY 1),
  u AS (SELECT sid, n_regionkey AS donor, pre, post, 'region' AS meta_var, r_name AS meta_val FROM c JOIN nation ON sid = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT sid, n_regionkey, pre, post, 'half', CASE WHEN sid < 12 THEN 'low' ELSE 'high' END FROM c JOIN nation ON sid = n_nationkey),
  a AS (SELECT meta_var, meta_val, SUM(pre) AS c0, SUM(post) AS c1, COUNT(CASE WHEN pre > 0 THEN 1 END) AS s0, COUNT(CASE WHEN post > 0 THEN 1 END) AS s1, COUNT(DISTINCT donor) AS d0, COUNT(DISTINCT CASE WHEN post > 0 THEN donor END) AS d1 FROM u GROUP BY 1, 2)
  SELECT meta_var, meta_val, 'cells' AS count_var, CAST(c1 AS BIGINT) AS kept, CAST(c0 - c1 AS BIGINT) AS excluded FROM a UNION ALL SELECT meta_var, meta_val, 'samples', s1, s0 - s1 FROM a UNION ALL SELECT meta_var, meta_val, 'donors', d1, d0 - d1 FROM a""")
def totals_by_metadata(spark, sf):
    c = roles.filtered_cells(spark, sf).join(roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("sample_id")), "cell_id")
    nat = roles.table(spark, sf, "nation").join(roles.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    meta = nat.select(F.col("n_nationkey").alias("sample_id"), F.col("n_regionkey").alias("subject_id"), F.col("r_name").alias("region"), F.when(F.col("n_nationkey") < 12, "low").otherwise("high").alias("half"))
    return qc.totals_by_metadata(c, meta, ["region", "half"])


@query("cluster_qc_long", QC + f""", cl AS (SELECT c_custkey AS cell_id, 'res_1' AS res, CAST(c_nationkey AS VARCHAR) AS cluster FROM customer UNION ALL SELECT c_custkey, 'res_2', c_mktsegment FROM customer),
  b AS (SELECT res, cluster FROM cl GROUP BY 1, 2 HAVING COUNT(*) >= 60), k AS (SELECT cell_id, 'log_counts' AS qc_var, log_counts AS v FROM m UNION ALL SELECT cell_id, 'logit_mito', logit_mito FROM m)
  SELECT cell_id, res, cluster, qc_var, {rnd('v')} AS qc_val FROM cl JOIN b USING (res, cluster) JOIN k USING (cell_id)""")
def cluster_qc_long(spark, sf):
    cl = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("res_1"), F.col("c_mktsegment").alias("res_2"))
    return rounded(summaries.cluster_qc_long(roles.qc_cells(spark, sf), cl, ["res_1", "res_2"], ["log_counts", "logit_mito"], 60))


@query("metric_pairs", QC + f""" SELECT cell_id, 'log_feats' AS var_x, 'log_counts' AS var_y, {rnd('log_feats')} AS x, {rnd('log_counts')} AS y FROM m
  UNION ALL SELECT cell_id, 'logit_mito', 'log_counts', {rnd('logit_mito')}, {rnd('log_counts')} FROM m UNION ALL SELECT cell_id, 'logit_mito', 'log_feats', {rnd('logit_mito')}, {rnd('log_feats')} FROM m""")
def metric_pairs(spark, sf):
    return rounded(joins.pair_columns(roles.qc_cells(spark, sf), ["cell_id"], ["log_counts", "log_feats", "logit_mito"]))


@query("drop_bad_batches", QC + """, k AS (SELECT batch FROM f WHERE keep GROUP BY 1 HAVING COUNT(*) >= 200) SELECT batch, cell_id FROM f WHERE batch IN (SELECT batch FROM k) AND keep""")
def drop_bad_batches(spark, sf):
    f = roles.filtered_cells(spark, sf)
    return qc.drop_bad_batches(f.where("keep").select("batch", "cell_id"), qc.sample_qc_stats(f, roles.cuts(spark, sf)))


@query("sample_status_ambient", QC + """, k AS (SELECT batch, COUNT(*) AS n_cells FROM f WHERE keep GROUP BY 1)
  SELECT batch, CAST(200 AS BIGINT) AS min_cells, n_cells, n_cells < 200 AS bad_qc, false AS bad_bender, n_cells < 200 AS bad_batch FROM k
  UNION ALL SELECT DISTINCT c_mktsegment, NULL, NULL, false, true, true FROM customer WHERE c_mktsegment LIKE 'F%'""")
def sample_status_ambient(spark, sf):
    failed = roles.cell_batches(spark, sf).where(F.col("batch").startswith("F"))
    return qc.sample_qc_stats(roles.filtered_cells(spark, sf), roles.cuts(spark, sf), failed_batches=failed)


@query("subset_by_label", "SELECT c_custkey AS cell_id FROM customer WHERE CAST(c_nationkey AS VARCHAR) IN ('3', '7')")
def subset_by_label(spark, sf):
    return qc.subset_by_label(roles.table(spark, sf, "customer"), "c_nationkey", ["3", "7"]).select(F.col("c_custkey").alias("cell_id"))


@query("full_outer_coalesce", """SELECT doc_id, quality, toxic, source FROM (SELECT doc_id, quality, toxic FROM labels) FULL JOIN (SELECT doc_id, source FROM documents WHERE lang <> 'en') USING (doc_id)""")
def full_outer_coalesce(spark, sf):
    d = roles.table(spark, sf, "documents").where("lang <> 'en'").select("doc_id", "source")
    return joins.full_outer(roles.table(spark, sf, "labels"), d, "doc_id").select("doc_id", "quality", "toxic", "source")


@query("left_fill", "SELECT d.doc_id, coalesce(quality, -1) AS quality FROM documents d LEFT JOIN labels USING (doc_id)")
def left_fill(spark, sf):
    return joins.attach(roles.table(spark, sf, "documents").select("doc_id"), roles.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", {"quality": -1})


@query("semi_anti", """SELECT doc_id, 'in' AS side FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'out' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def semi_anti(spark, sf):
    d, lab = roles.table(spark, sf, "documents").select("doc_id"), roles.table(spark, sf, "labels").select("doc_id")
    return joins.keep_in(d, lab, "doc_id").withColumn("side", F.lit("in")).unionByName(joins.keep_not_in(d, lab, "doc_id").withColumn("side", F.lit("out")))


@query("order_lookup", """SELECT n_name, CAST(24 - n_nationkey AS INTEGER) AS ord, c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey""")
def order_lookup(spark, sf):
    ids = roles.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", (24 - F.col("n_nationkey")).alias("ord"))
    got = joins.lookup_in_order(ids, roles.table(spark, sf, "customer"), "c_nationkey", "ord")
    return got.join(ids.select("c_nationkey", "n_name"), "c_nationkey").select("n_name", "ord", "c_custkey")


@query("translate_barcodes", """SELECT l_partkey % 100 AS barcode, SUM(l_quantity) AS total FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 30 GROUP BY 1""")
def translate_barcodes(spark, sf):
    li = roles.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("barcode"), "l_quantity")
    d = roles.table(spark, sf, "part").where("p_size <= 30").select(F.col("p_partkey").alias("barcode"), (F.col("p_partkey") % 100).alias("rna"))
    return joins.translate_ids(li, d, "barcode", "rna").groupBy("barcode").agg(F.sum("l_quantity").alias("total"))


@query("contained_names", """WITH n AS (SELECT DISTINCT n_name AS id FROM nation) SELECT a.id AS inner_id, b.id AS outer_id FROM n a, n b WHERE a.id <> b.id AND contains(b.id, a.id)""")
def contained_names(spark, sf):
    return joins.contained_ids(roles.table(spark, sf, "nation"), "n_name")


@query("membership_flag", "SELECT doc_id, source, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS good FROM documents d")
def membership_flag(spark, sf):
    ok = roles.table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return joins.membership_flag(roles.table(spark, sf, "documents").select("doc_id", "source"), ok, ["doc_id"], "good")


@query("marker_lookup", """WITH b AS (SELECT p_name AS symbol, p_partkey AS gene_id, row_number() OVER (PARTITION BY p_name ORDER BY p_retailprice DESC, p_partkey DESC) AS i FROM part)
  SELECT p_brand AS label, p.p_partkey AS ensembl_id, symbol, gene_id FROM part p JOIN b ON p.p_name = symbol WHERE i = 1 AND p_size < 5""")
def marker_lookup(spark, sf):
    p = roles.table(spark, sf, "part")
    custom = p.where("p_size < 5").select(F.col("p_brand").alias("label"), F.col("p_partkey").alias("ensembl_id"))
    genes = p.select(F.col("p_partkey").alias("ensembl_id"), F.col("p_name").alias("symbol"))
    var = p.select(F.col("p_name").alias("symbol"), F.col("p_partkey").alias("gene_id"), F.col("p_retailprice").alias("vst_var"))
    return joins.marker_lookup(custom, genes, var).select("label", "ensembl_id", "symbol", "gene_id")


@query("assign_external", """WITH c AS (SELECT doc_id AS cell_id, source AS pool_id FROM documents), s AS (SELECT doc_id AS cell_id, CASE WHEN quality = 1 THEN 's1' ELSE 's0' END AS sample_id, CASE WHEN toxic = 1 THEN 'doublet' END AS class FROM labels)
  SELECT pool_id, cell_id, sample_id, CASE WHEN sample_id = 's1' THEN pool_id || '_x' END AS tissue, coalesce(class, CASE WHEN sample_id IS NOT NULL THEN 'singlet' ELSE 'negative' END) AS demux_class FROM c LEFT JOIN s USING (cell_id)""")
def assign_external(spark, sf):
    d = roles.table(spark, sf, "documents").select(F.col("doc_id").alias("cell_id"), F.col("source").alias("pool_id"))
    a = d.join(roles.table(spark, sf, "labels").select(F.col("doc_id").alias("cell_id"), F.when(F.col("quality") == 1, "s1").otherwise("s0").alias("sample_id"),
                                                      F.when(F.col("toxic") == 1, "doublet").alias("class")), "cell_id")
    meta = d.select("pool_id").distinct().select("pool_id", F.lit("s1").alias("sample_id"), F.concat("pool_id", F.lit("_x")).alias("tissue"))
    return joins.assign_external(d, a, meta).select("pool_id", "cell_id", "sample_id", "tissue", "demux_class")


@query("cell_metadata", """SELECT c_custkey AS cell_id, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def cell_metadata(spark, sf):
    nat = roles.table(spark, sf, "nation").join(roles.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("n_nationkey"))
    return c.join(nat.select("n_nationkey", "n_name", "r_name"), "n_nationkey").select("cell_id", "n_name", "r_name")


@query("list_pools", """SELECT r_name AS pool_id, string_agg(n_name, ',' ORDER BY n_name) AS samples FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def list_pools(spark, sf):
    nat = roles.table(spark, sf, "nation").join(roles.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nat.groupBy(F.col("r_name").alias("pool_id")).agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("samples"))


@query("bins", """SELECT p_partkey, CASE WHEN p_size <= 1 THEN NULL WHEN p_size <= 10 THEN '<=10' WHEN p_size <= 20 THEN '<=20' WHEN p_size <= 40 THEN '<=40' ELSE '<=Inf' END AS size_cat FROM part""")
def bins(spark, sf):
    return roles.table(spark, sf, "part").select("p_partkey", S.right_closed_bin("p_size", (1, 10, 20, 40, S.INF if hasattr(S, "INF") else float("inf"))).alias("size_cat"))


@query("bin2d_density", f"""WITH e AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings), r AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM e)
  SELECT CAST(least(floor((x - x0) / (x1 - x0) * 20), 19) AS INTEGER) AS x_bin, CAST(least(floor((y - y0) / (y1 - y0) * 20), 19) AS INTEGER) AS y_bin, COUNT(*) AS n, {rnd('avg(label)')} AS mean_label FROM e, r GROUP BY 1, 2""")
def bin2d_density(spark, sf):
    e = roles.table(spark, sf, "embeddings").select("label", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    return rounded(summaries.bin2d(e, "x", "y", 20, "label"))


@query("rescale", f"""WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
  SELECT vec_id, {rnd('0.05 + 0.9 * (x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ())')} AS x, {rnd('0.05 + 0.9 * (y - min(y) OVER ()) / (max(y) OVER () - min(y) OVER ())')} AS y FROM e""")
def rescale(spark, sf):
    e = roles.table(spark, sf, "embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"), F.element_at("embedding", 2).cast("double").alias("y"))
    return rounded(summaries.rescale(e, ["x", "y"]))


@query("expression_on_embedding", X + f""", l AS (SELECT cell_id, SUM(n) AS lib FROM g GROUP BY 1), pn AS (SELECT p_partkey AS gene_id, p_name AS symbol FROM part WHERE p_name LIKE 'red %'),
  e AS (SELECT cell_id, gene_id, symbol, ln(1 + n / lib * 10000) AS v FROM g JOIN l USING (cell_id) JOIN pn USING (gene_id)),
  d AS (SELECT pn.gene_id, coalesce(v, 0) AS v FROM pn CROSS JOIN l LEFT JOIN e ON e.gene_id = pn.gene_id AND e.cell_id = l.cell_id),
  q AS (SELECT gene_id, quantile_cont(v, 0.99) AS q FROM d GROUP BY 1)
  SELECT cell_id, gene_id, symbol, {rnd('v')} AS logcount, {rnd('CASE WHEN q > 0 THEN q ELSE 1 END')} AS max_val, {rnd('least(v / CASE WHEN q > 0 THEN q ELSE 1 END, 1)')} AS norm_val FROM e JOIN q USING (gene_id)""")
def expression_on_embedding(spark, sf):
    gs = C.sum_splice(roles.cell_counts(spark, sf))
    return rounded(summaries.expression_on_embedding(gs, C.library_sizes(gs), roles.genes(spark, sf).where("is_mito"), roles.n_cells(spark, sf)))


# ---- reshape ----

@query("unpivot_pairs", """WITH a AS (SELECT l_orderkey, SUM(l_quantity) AS q, SUM(l_tax) AS t, SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS q1, SUM(CASE WHEN l_linestatus = 'F' THEN l_tax ELSE 0 END) AS t1 FROM lineitem GROUP BY 1)
  SELECT l_orderkey, 'pre' AS stage, q AS qty, round(t, 6) + 0.0 AS tax FROM a UNION ALL SELECT l_orderkey, 'post', q1, round(t1, 6) + 0.0 FROM a""")
def unpivot_pairs(spark, sf):
    f = F.col("l_linestatus") == "F"
    a = roles.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("pre_qty"), F.sum("l_tax").alias("pre_tax"), F.sum(F.when(f, F.col("l_quantity")).otherwise(0.0)).alias("post_qty"), F.sum(F.when(f, F.col("l_tax")).otherwise(0.0)).alias("post_tax"))
    return rounded(reshape.unpivot_pairs(a, ["l_orderkey"], ["pre", "post"], ["qty", "tax"]))


@query("unpivot_matching", """SELECT o_orderkey, 'o_orderstatus' AS var, o_orderstatus AS val FROM orders UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders""")
def unpivot_matching(spark, sf):
    o = roles.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return reshape.unpivot_matching(o, ["o_orderkey"], "^o_order(status|priority)$", "var", "val")


@query("pivot_filled", """SELECT l_partkey AS gene_id, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS DOUBLE) AS "R", CAST(SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS DOUBLE) AS "N" FROM lineitem GROUP BY 1""")
def pivot_filled(spark, sf):
    li = roles.table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "gene_id")
    return reshape.pivot_filled(li, "gene_id", "l_returnflag", ["R", "N"], "l_quantity")


@query("membership_matrix", """SELECT user_id, MAX(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS click, MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS error FROM events GROUP BY 1""")
def membership_matrix(spark, sf):
    return reshape.membership_matrix(roles.table(spark, sf, "events"), "user_id", "event_type", ["click", "error"])


@query("select_strip_tag", "SELECT orderkey, orderstatus, orderpriority, orderdate::VARCHAR[:10] AS orderdate, 'x' AS model FROM (SELECT o_orderkey AS orderkey, o_orderstatus AS orderstatus, o_orderpriority AS orderpriority, o_orderdate AS orderdate FROM orders)".replace("orderdate::VARCHAR[:10]", "strftime(orderdate, '%Y-%m-%d')"))
def select_strip_tag(spark, sf):
    o = reshape.strip_prefix(reshape.select_matching(roles.table(spark, sf, "orders"), "^o_order"), "o_")
    return reshape.tag(o.withColumn("orderdate", F.date_format("orderdate", "yyyy-MM-dd")), model="x")


# ---- windows, sorts, sets ----

@query("mid_rank_nulls", """WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN round(c_acctbal / 500) END AS v FROM customer)
  SELECT c_custkey, c_mktsegment, v + 0.0 AS v, CASE WHEN v IS NOT NULL THEN CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY v DESC NULLS LAST) + (COUNT(*) OVER (PARTITION BY c_mktsegment, v) - 1) / 2.0 AS DOUBLE) END AS rank FROM c""")
def mid_rank_nulls(spark, sf):
    c = roles.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") > 0, F.round(F.col("c_acctbal") / 500.0)).alias("v"))
    return ordered.mid_rank(c, "c_mktsegment", "v")


@query("row_positions", "SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey DESC, o_orderkey) AS position FROM orders")
def row_positions(spark, sf):
    o = roles.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return ordered.positions(o, "o_orderpriority", "o_custkey", "o_orderkey").drop("o_custkey")


@query("running_counts", "SELECT o_custkey, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER (ORDER BY o_custkey) AS BIGINT) AS cum, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS group_n FROM orders GROUP BY 1")
def running_counts(spark, sf):
    return ordered.running_counts(roles.table(spark, sf, "orders"), None, "o_custkey")


@query("top_per_group", "SELECT c_mktsegment, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS i FROM customer) WHERE i <= 5")
def top_per_group(spark, sf):
    return joins.first_per_group(roles.table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal"), "c_mktsegment", [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], 5).drop("c_acctbal")


@query("group_min_max", "SELECT p_partkey, MIN(p_retailprice) OVER (PARTITION BY p_brand) AS lo, MAX(p_retailprice) OVER (PARTITION BY p_brand) AS hi, COUNT(*) OVER (PARTITION BY p_brand) AS n FROM part")
def group_min_max(spark, sf):
    p = roles.table(spark, sf, "part")
    g = p.groupBy("p_brand").agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"), F.count(F.lit(1)).alias("n"))
    return p.select("p_partkey", "p_brand").join(g, "p_brand").drop("p_brand")


@query("genomic_order", """WITH f AS (SELECT p_brand, COUNT(*) AS k FROM part GROUP BY 1)
  SELECT p_partkey AS gene_id, row_number() OVER (ORDER BY CASE WHEN p_brand = 'Brand#1' THEN 1 ELSE 0 END, k DESC, p_brand, p_size, p_retailprice, p_partkey) AS ord FROM part JOIN f USING (p_brand)""")
def genomic_order(spark, sf):
    from tallyloom.sources import annotations

    g = annotations.order_chromosomes(roles.genes(spark, sf), last="Brand#1")
    w = Window.orderBy("chromosome_ord", "start", "end", "gene_id")  # one row per gene of the annotation
    return g.select("gene_id", F.row_number().over(w).cast("long").alias("ord"))


@query("set_operations", """SELECT 'intersect' AS op, COUNT(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT 'except', COUNT(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
  UNION ALL SELECT 'union', COUNT(*) FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels) UNION ALL SELECT 'distinct', COUNT(*) FROM (SELECT DISTINCT quality, toxic FROM labels)""")
def set_operations(spark, sf):
    d, lab = roles.table(spark, sf, "documents").select("doc_id"), roles.table(spark, sf, "labels")
    ids = lab.select("doc_id")
    parts = {"intersect": d.intersect(ids), "except": d.subtract(ids), "union": d.union(ids).distinct(), "distinct": lab.select("quality", "toxic").dropDuplicates()}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("union_fill", "SELECT doc_id, quality, toxic, NULL::VARCHAR AS lang FROM labels UNION ALL SELECT doc_id, NULL, NULL, lang FROM documents")
def union_fill(spark, sf):
    return roles.table(spark, sf, "labels").unionByName(roles.table(spark, sf, "documents").select("doc_id", "lang"), allowMissingColumns=True)


# ---- scalars ----

@query("scalar_text", """SELECT p_partkey, regexp_replace(p_name || '_S', '_[SUA]$', '') AS gene, 'S' AS splice, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', -1) AS last_word, regexp_replace(p_brand, '^Brand', '') AS stripped,
  replace(lower(trim(p_name)), ' ', '_') AS clean, CASE WHEN length(CAST(p_size AS VARCHAR)) >= 2 THEN CAST(p_size AS VARCHAR) ELSE lpad(CAST(p_size AS VARCHAR), 2, '0') END AS padded, p_name || '_' || p_brand AS key,
  list_contains(string_split('LARGE,PROMO', ','), p_type) AS hit, substr(p_name, 1, 4) AS short, regexp_extract('RNA_snn_res.' || CAST(p_size AS VARCHAR), 'res\\.(.+)$', 1) AS res, CASE p_type WHEN 'LARGE' THEN 'big' ELSE p_type END AS recoded FROM part""")
def scalar_text(spark, sf):
    f = F.concat("p_name", F.lit("_S"))
    return roles.table(spark, sf, "part").select(
        "p_partkey", S.feature_gene(f).alias("gene"), S.feature_splice(f).alias("splice"), S.before_first("p_name", " ").alias("first_word"), S.after_last("p_name", " ").alias("last_word"),
        S.strip_prefix_once("p_brand", "Brand").alias("stripped"), S.clean_label("p_name").alias("clean"), S.zero_pad("p_size").alias("padded"), S.make_key("p_name", "p_brand").alias("key"),
        S.csv_contains(F.lit("LARGE,PROMO"), F.col("p_type")).alias("hit"), S.short_name("p_name", 4).alias("short"),
        S.resolution_of(F.concat(F.lit("RNA_snn_res."), F.col("p_size").cast("string"))).alias("res"), S.recode("p_type", {"LARGE": "big"}).alias("recoded"))


@query("scalar_numbers", f"""WITH p AS (SELECT p_partkey, p_size, p_retailprice AS v, (p_size - 1) / 49.0 AS s FROM part)
  SELECT p_partkey, {rnd("CASE WHEN s <= 0 THEN -99 WHEN s >= 1 THEN 99 ELSE ln(s / (1 - s)) END")} AS lg, {rnd('1 / (1 + exp(-(p_size / 10.0)))')} AS inv, {rnd('CASE WHEN p_size - 25 = 0 THEN 0 ELSE v / (p_size - 25) END')} AS ratio,
  {rnd('least(greatest(v, 950), 1200)')} AS cl, round_even(p_size / 2.0, 0)::DOUBLE AS half_even, {rnd('CASE WHEN s > 0 THEN s * log2(s) ELSE 0 END')} AS ent, CASE WHEN s > 0.05 THEN '' WHEN s > 0.01 THEN '*' WHEN s > 0.001 THEN '**' ELSE '***' END AS st,
  {rnd('lgamma(p_size + 1)')} AS lf, v >= 950 AND v <= 1100 AS ins, p_size + 1e-10 < 10 AS lo, p_size - 1e-10 > 40 AS hi FROM p""")
def scalar_numbers(spark, sf):
    p = roles.table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_retailprice").alias("v"), ((F.col("p_size") - 1) / 49.0).alias("s"))
    return rounded(p.select(
        "p_partkey", S.clamp(S.logit("s"), -99.0, 99.0).alias("lg"), S.inv_logit(F.col("p_size") / 10.0).alias("inv"), S.safe_ratio("v", F.col("p_size") - 25).alias("ratio"), S.clamp("v", 950.0, 1200.0).alias("cl"),
        S.round_half_even(F.col("p_size") / 2.0).cast("double").alias("half_even"), S.entropy_term("s").alias("ent"), S.stars("s").alias("st"), S.ln_factorial("p_size").alias("lf"),
        S.inside("v", F.lit(950.0), F.lit(1100.0)).alias("ins"), S.below("p_size", F.lit(10)).alias("lo"), S.above("p_size", F.lit(40)).alias("hi")))


@query("scalar_json_dates", """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS k, coalesce(TRY_CAST(json_extract_string(props, '$.none') AS DOUBLE), -1) AS missing,
  regexp_matches(strftime(ts, '%Y-%m-%d'), '^20[0-9]{2}-[0-9]{2}-[0-9]{2}$') AS is_stamp, event_type IN ('click') AS flag FROM events""")
def scalar_json_dates(spark, sf):
    e = roles.table(spark, sf, "events")
    return e.select("event_id", S.json_number("props", "$.k").alias("k"), S.json_number("props", "$.none", -1).alias("missing"),
                    S.is_date_stamp(F.date_format("ts", "yyyy-MM-dd")).alias("is_stamp"), S.parse_flag(F.when(F.col("event_type") == "click", "TRUE").otherwise("no")).alias("flag"))


@query("ordered_levels", """WITH f AS (SELECT p_type, COUNT(*) AS n FROM part GROUP BY 1) SELECT p_type AS level, CAST(row_number() OVER (ORDER BY CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END, n DESC, p_type) AS BIGINT) AS ord FROM f""")
def ordered_levels(spark, sf):
    from tallyloom.sources import annotations

    return annotations.level_order(roles.table(spark, sf, "part"), "p_type", last="PROMO").select("level", "ord")

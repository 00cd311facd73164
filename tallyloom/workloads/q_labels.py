"""Label and cluster queries."""

from pyspark.sql import functions as F

from tallyloom.operators import counts as C
from tallyloom.operators import labels as L
from tallyloom.workloads import roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import X, rnd


def predictions(spark, sf):
    """cell = document; predicted label = language, probability from the text length"""
    return roles.table(spark, sf, "documents").select(
        F.col("doc_id").alias("cell_id"), F.col("lang").alias("predicted_label"),
        (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("probability"))


def doc_clusters(spark, sf):
    return roles.table(spark, sf, "documents").select(F.col("doc_id").alias("cell_id"), F.col("source").alias("hi_res_cl"))


@query("majority_label", f"""WITH c AS (SELECT source, lang, COUNT(*) AS n FROM documents GROUP BY 1, 2),
  s AS (SELECT *, n / SUM(n) OVER (PARTITION BY source) AS p, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS i FROM c)
  SELECT doc_id AS cell_id, source AS hi_res_cl, documents.lang AS predicted_label_naive, {rnd('n_chars / (n_chars + 1000.0)')} AS probability_naive,
  CASE WHEN p < 0.55 THEN 'ambiguous' ELSE s.lang END AS predicted_label_agg, {rnd('p')} AS prop_hi_res_cl FROM documents JOIN s USING (source) WHERE i = 1""")
def majority_label(spark, sf):
    return rounded(L.majority_label(predictions(spark, sf), doc_clusters(spark, sf), 0.55))


@query("label_by_resolution", f"""WITH d AS (SELECT doc_id, lang, source AS a, substr(source, 1, 4) AS b FROM documents),
  u AS (SELECT doc_id, lang, 'res_1' AS res, a AS cl FROM d UNION ALL SELECT doc_id, lang, 'res_0_1', b FROM d),
  sz AS (SELECT res, cl, COUNT(*) AS n FROM u GROUP BY 1, 2),
  c AS (SELECT res, cl, lang, COUNT(*) AS k FROM u GROUP BY 1, 2, 3),
  s AS (SELECT *, k / SUM(k) OVER (PARTITION BY res, cl) AS p, row_number() OVER (PARTITION BY res, cl ORDER BY k DESC, lang) AS i FROM c),
  t AS (SELECT res, cl, s.lang AS pred, p FROM s JOIN sz USING (res, cl) WHERE i = 1 AND p > 0.5 AND n >= 40),
  w AS (SELECT u.doc_id, u.res, u.cl, pred, p FROM u LEFT JOIN t USING (res, cl))
  SELECT doc_id AS cell_id, MAX(CASE WHEN res = 'res_1' THEN cl END) AS cl_int_res_1, MAX(CASE WHEN res = 'res_1' THEN pred END) AS cl_pred_res_1,
  {rnd("MAX(CASE WHEN res = 'res_1' THEN p END)")} AS prop_pred_res_1, MAX(CASE WHEN res = 'res_0_1' THEN cl END) AS cl_int_res_0_1,
  MAX(CASE WHEN res = 'res_0_1' THEN pred END) AS cl_pred_res_0_1, {rnd("MAX(CASE WHEN res = 'res_0_1' THEN p END)")} AS prop_pred_res_0_1 FROM w GROUP BY 1""")
def label_by_resolution(spark, sf):
    cl = doc_clusters(spark, sf).select("cell_id", F.col("hi_res_cl").alias("res_1"), F.substring("hi_res_cl", 1, 4).alias("res_0_1"))
    return rounded(L.label_by_resolution(predictions(spark, sf), cl, ["res_1", "res_0_1"], 0.5, 40))


_CF = """WITH n AS (SELECT lang AS cl1, source AS cl2, COUNT(*) AS n FROM documents GROUP BY 1, 2),
  f AS (SELECT a.cl1, b.cl2, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT cl1 FROM n) a CROSS JOIN (SELECT DISTINCT cl2 FROM n) b LEFT JOIN n ON n.cl1 = a.cl1 AND n.cl2 = b.cl2)"""


@query("confusion", _CF + f" SELECT cl1, cl2, n, {rnd('CAST(n + 0.1 AS DOUBLE)')} AS n0, {rnd('ln(n + 0.1)')} AS log_n, "
       f"{rnd('n / SUM(n) OVER (PARTITION BY cl1)')} AS p_cl1, {rnd('ln((n + 0.1) / SUM(n + 0.1) OVER (PARTITION BY cl1))')} AS log_p_cl1, "
       f"{rnd('n / SUM(n) OVER (PARTITION BY cl2)')} AS p_cl2, {rnd('ln((n + 0.1) / SUM(n + 0.1) OVER (PARTITION BY cl2))')} AS log_p_cl2 FROM f")
def confusion(spark, sf):
    return rounded(L.confusion(predictions(spark, sf), doc_clusters(spark, sf), "predicted_label", "hi_res_cl"))


@query("confusion_labels", _CF.replace("n AS (SELECT lang AS cl1, source AS cl2, COUNT(*) AS n FROM documents GROUP BY 1, 2)",
       """n0 AS (SELECT source AS cl1, lang AS cl2, COUNT(*) AS n FROM documents GROUP BY 1, 2),
  bp AS (SELECT cl1, MAX(p) AS mp FROM (SELECT *, n / SUM(n) OVER (PARTITION BY cl2) AS p FROM n0) GROUP BY 1), n AS (SELECT n0.* FROM n0 JOIN bp USING (cl1) WHERE mp >= 0.06)""")
       + f" SELECT cl1, cl2, n, CAST(n + 1 AS DOUBLE) AS n0, {rnd('ln(n + 1)')} AS log_n, "
       f"{rnd('(n + 1) / SUM(n + 1) OVER (PARTITION BY cl1)')} AS p_cl1, {rnd('ln((n + 1) / SUM(n + 1) OVER (PARTITION BY cl1))')} AS log_p_cl1, "
       f"{rnd('(n + 1) / SUM(n + 1) OVER (PARTITION BY cl2)')} AS p_cl2, {rnd('ln((n + 1) / SUM(n + 1) OVER (PARTITION BY cl2))')} AS log_p_cl2 FROM f")
def confusion_labels(spark, sf):
    return rounded(L.confusion(doc_clusters(spark, sf), predictions(spark, sf), "hi_res_cl", "predicted_label", 1.0, False, 0.06))


@query("cluster_entropy", f"""WITH n AS (SELECT lang AS batch, source AS cluster, COUNT(*) AS n FROM documents GROUP BY 1, 2),
  s AS (SELECT *, n / SUM(n) OVER (PARTITION BY batch) AS ps, n / SUM(n) OVER (PARTITION BY cluster) AS pc FROM n),
  t AS (SELECT *, ps / SUM(ps) OVER (PARTITION BY cluster) AS pn FROM s)
  SELECT cluster, {rnd('-SUM(pc * log2(pc))')} AS h_cl_raw, {rnd('-SUM(pn * log2(pn))')} AS h_cl_norm, {rnd('100 * MAX(pc)')} AS max_pct_raw,
  {rnd('100 * MAX(pn)')} AS max_pct_norm, CAST(SUM(n) AS BIGINT) AS n FROM t GROUP BY 1""")
def cluster_entropy(spark, sf):
    d = roles.table(spark, sf, "documents").select(F.col("lang").alias("batch"), F.col("source").alias("cluster"))
    return rounded(L.cluster_entropy(d))


@query("cluster_relabel", """WITH n AS (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY 1),
  r AS (SELECT label, 'cl' || lpad(CAST(row_number() OVER (ORDER BY n DESC, label) AS VARCHAR), 2, '0') AS cluster FROM n)
  SELECT vec_id AS cell_id, cluster FROM embeddings JOIN r USING (label)""")
def cluster_relabel(spark, sf):
    e = roles.table(spark, sf, "embeddings").select(F.col("vec_id").alias("cell_id"), F.col("label").alias("cluster"))
    return L.relabel_by_size(e, "cluster").select("cell_id", "cluster")


@query("cluster_by_metadata", f"""WITH n AS (SELECT c_nationkey, c_mktsegment AS cluster, COUNT(*) AS n FROM customer GROUP BY 1, 2),
  u AS (SELECT 'region' AS meta_var, r_name AS meta_val, cluster, n FROM n JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'nation', n_name, cluster, n FROM n JOIN nation ON c_nationkey = n_nationkey),
  s AS (SELECT meta_var, meta_val, cluster, CAST(SUM(n) AS BIGINT) AS n FROM u GROUP BY 1, 2, 3),
  k AS (SELECT a.meta_var, a.meta_val, b.cluster FROM (SELECT DISTINCT meta_var, meta_val FROM s) a CROSS JOIN (SELECT DISTINCT cluster FROM s) b),
  z AS (SELECT k.*, coalesce(s.n, 0) AS n FROM k LEFT JOIN s USING (meta_var, meta_val, cluster))
  SELECT meta_var, meta_val, cluster, n, {rnd('n / SUM(n) OVER (PARTITION BY meta_var, cluster)')} AS prop FROM z""")
def cluster_by_metadata(spark, sf):
    cells = roles.table(spark, sf, "customer").select(F.col("c_nationkey").alias("sample_id"), F.col("c_mktsegment").alias("cluster"))
    nat = roles.table(spark, sf, "nation").join(roles.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    meta = nat.select(F.col("n_nationkey").alias("sample_id"), F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    return rounded(L.cluster_by_metadata(cells, meta, ["region", "nation"]))


_EMB = """WITH e AS (SELECT vec_id AS cell_id, 'cl' || CAST(label AS VARCHAR) AS cluster, coalesce(toxic = 1, false) AS is_dbl
  FROM embeddings LEFT JOIN labels ON vec_id = labels.doc_id),
  s AS (SELECT cluster, COUNT(*) AS k, COUNT(CASE WHEN is_dbl THEN 1 END) / COUNT(*) AS p FROM e GROUP BY 1)"""


@query("doublet_clusters", _EMB + f""" SELECT cell_id, cluster, is_dbl, {rnd('p')} AS dbl_prop, k AS dbl_cl_size, p > 0.06 AS in_dbl_cl, NOT is_dbl AND NOT p > 0.06 AS keep
  FROM e JOIN s USING (cluster)""")
def doublet_clusters(spark, sf):
    return rounded(L.doublet_clusters(roles.embedding(spark, sf).select("cell_id", "cluster", "is_dbl"), max_prop=0.06))


@query("doublet_cluster_share", _EMB + f" SELECT cluster, k AS dbl_cl_size, {rnd('100 * p')} AS dbl_pct FROM s")
def doublet_cluster_share(spark, sf):
    return rounded(L.doublet_cluster_share(roles.embedding(spark, sf)))


@query("drop_small_groups", """SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM documents GROUP BY 1 HAVING COUNT(*) >= 50)""")
def drop_small_groups(spark, sf):
    return L.drop_small_groups(roles.table(spark, sf, "documents").select("doc_id", "source"), "source", 50)


@query("value_counts_share", f"""SELECT source, lang, COUNT(*) AS n, {rnd('COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY source)')} AS prop FROM documents GROUP BY 1, 2""")
def value_counts_share(spark, sf):
    return rounded(L.with_share(L.value_counts(roles.table(spark, sf, "documents"), ["source", "lang"]), "source"))


@query("classify_cells", X + f""", l AS (SELECT cell_id, SUM(n) AS lib FROM g GROUP BY 1),
  lg AS (SELECT cell_id, gene_id, ln(1 + n / lib * 10000) AS v FROM g JOIN l USING (cell_id)),
  md AS (SELECT p_type AS class, p_partkey AS gene_id, p_size / 100.0 AS weight FROM part),
  ic AS (SELECT p_type AS class, -avg(p_size) AS intercept FROM part GROUP BY 1),
  s AS (SELECT cell_id, class, SUM(v * weight) AS s FROM lg JOIN md USING (gene_id) GROUP BY 1, 2),
  t AS (SELECT cell_id, class, s + intercept AS t FROM s JOIN ic USING (class)),
  b AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY t DESC, class) AS i FROM t)
  SELECT cell_id, class AS predicted_label, {rnd('1 / (1 + exp(-t))')} AS probability FROM b WHERE i = 1""")
def classify_cells(spark, sf):
    gs = C.sum_splice(roles.cell_counts(spark, sf))
    logc = C.log_normalise(gs, C.library_sizes(gs))
    p = roles.table(spark, sf, "part")
    model = p.select(F.col("p_type").alias("class"), F.col("p_partkey").alias("gene_id"), (F.col("p_size") / 100.0).alias("weight"))
    icpt = p.groupBy(F.col("p_type").alias("class")).agg((-F.avg("p_size")).alias("intercept"))
    return rounded(L.classify_cells(logc, model, icpt))


@query("subset_sample_stats", """WITH c AS (SELECT c_mktsegment AS batch, COUNT(*) AS n_cells FROM customer WHERE c_nationkey IN (1, 2) AND c_mktsegment <> 'BUILDING' GROUP BY 1),
  b AS (SELECT DISTINCT c_mktsegment AS batch FROM customer)
  SELECT batch, coalesce(n_cells, 0) AS n_cells, coalesce(n_cells, 0) < 20 OR batch = 'MACHINERY' AS bad_batch FROM b LEFT JOIN c USING (batch)""")
def subset_sample_stats(spark, sf):
    c = roles.clustered_cells(spark, sf)
    batches = c.select("batch").distinct()
    earlier = batches.withColumn("bad_batch", F.col("batch") == "MACHINERY")
    return L.subset_sample_stats(c.where(F.col("cluster").isin("cl01", "cl02") & (F.col("batch") != "BUILDING")), batches, earlier, 20)

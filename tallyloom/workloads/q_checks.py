"""Data checks run on the tables; an empty result is the expected one for several of them."""

from pyspark.sql import functions as F

from tallyloom.operators import checks
from tallyloom.workloads import q_hvg, roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import PB, QC, rnd


@query("check_sample_names", """WITH n AS (SELECT DISTINCT n_name AS id FROM nation) SELECT DISTINCT a.id AS name, 'contained in another' AS problem FROM n a, n b WHERE a.id <> b.id AND contains(b.id, a.id)
  UNION ALL SELECT n_name, 'duplicated' FROM nation GROUP BY 1 HAVING COUNT(*) > 1 UNION ALL SELECT DISTINCT n_name, 'has a blank' FROM nation WHERE contains(n_name, ' ')""")
def check_sample_names(spark, sf):
    return checks.sample_names(roles.table(spark, sf, "nation"), "n_name")


@query("check_blank_names", """WITH n AS (SELECT p_name AS id, COUNT(*) AS n FROM part GROUP BY 1) SELECT id AS name, 'has a blank' AS problem FROM n WHERE contains(id, ' ') UNION ALL SELECT id, 'duplicated' FROM n WHERE n > 1
  UNION ALL SELECT DISTINCT a.id, 'contained in another' FROM n a, n b WHERE a.id <> b.id AND contains(b.id, a.id)""")
def check_blank_names(spark, sf):
    return checks.sample_names(roles.table(spark, sf, "part"), "p_name")


@query("check_metadata_levels", "SELECT 'p_size' AS variable, COUNT(DISTINCT p_size) AS n_values, 'too many values' AS problem FROM part HAVING COUNT(DISTINCT p_size) > 10")
def check_metadata_levels(spark, sf):
    return checks.metadata_levels(roles.table(spark, sf, "part"), ["p_size", "p_type"])


@query("check_not_in_reference", "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def check_not_in_reference(spark, sf):
    return checks.not_in_reference(roles.table(spark, sf, "documents"), roles.table(spark, sf, "labels"), "doc_id")


@query("check_set_differences", """SELECT DISTINCT o_custkey AS id, 'first' AS only_in FROM orders WHERE o_custkey NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT doc_id, 'second' FROM documents WHERE doc_id NOT IN (SELECT o_custkey FROM orders)""")
def check_set_differences(spark, sf):
    return checks.set_differences(roles.table(spark, sf, "orders").select(F.col("o_custkey").alias("id")), roles.table(spark, sf, "documents").select(F.col("doc_id").alias("id")), "id")


_LISTED = "SELECT CASE WHEN l_quantity = 50 THEN l_partkey + 10000000 ELSE l_partkey END AS gene_id, l_returnflag FROM lineitem"  # lines of fifty name unknown genes


@query("check_exclusion_list", f"""WITH li AS ({_LISTED}) SELECT CAST(gene_id AS VARCHAR) AS value, 'duplicated' AS problem FROM li GROUP BY 1 HAVING COUNT(*) > 1
  UNION ALL SELECT DISTINCT CAST(gene_id AS VARCHAR), 'unknown' FROM li WHERE gene_id NOT IN (SELECT p_partkey FROM part)""")
def check_exclusion_list(spark, sf):
    return checks.exclusion_list(_listed(spark, sf).select("gene_id"), roles.genes(spark, sf))


def _listed(spark, sf):
    c = roles.cell_counts(spark, sf)
    return c.withColumn("gene_id", F.when(F.col("count") == 50, F.col("gene_id") + 10000000).otherwise(F.col("gene_id")))


@query("check_marker_set", "SELECT p_name AS symbol, COUNT(*) AS n FROM part GROUP BY 1 HAVING COUNT(*) > 1")
def check_marker_set(spark, sf):
    return checks.marker_set(roles.table(spark, sf, "part").select(F.col("p_brand").alias("label"), F.col("p_name").alias("symbol")))


@query("check_splice_features", f"""SELECT gene_id, CASE WHEN p_size IS NULL THEN 'unknown gene' ELSE 'incomplete' END AS problem
  FROM (SELECT gene_id, COUNT(DISTINCT l_returnflag) AS n FROM ({_LISTED}) GROUP BY 1) LEFT JOIN part ON gene_id = p_partkey WHERE n <> 3 OR p_size IS NULL""")
def check_splice_features(spark, sf):
    return checks.splice_features(_listed(spark, sf).select("gene_id", "splice"), roles.genes(spark, sf))


@query("check_qc_values", QC + " SELECT cell_id, 'bad value' AS problem FROM m WHERE log_counts < 0 OR log_feats < 0 OR isnan(logit_mito) OR isinf(logit_mito) OR cell_id % 40 = 0")
def check_qc_values(spark, sf):
    """Every fortieth cell gets a value that is no number."""
    cells = roles.qc_cells(spark, sf).withColumn("log_counts", F.when(F.col("cell_id") % 40 == 0, float("nan")).otherwise(F.col("log_counts")))
    return checks.qc_values(cells, ["log_counts", "log_feats", "logit_mito"])


@query("check_hvg_selection", q_hvg.RANK + " SELECT CAST(gene_id AS VARCHAR) AS value, 'excluded gene selected' AS problem FROM hv WHERE highly_variable AND gene_id IN (SELECT p_partkey FROM part WHERE p_type = 'SMALL')")
def check_hvg_selection(spark, sf):
    return checks.hvg_selection(q_hvg.hvgs(spark, sf), roles.genes(spark, sf).where("gene_type = 'SMALL'"), 200)


@query("check_proportions", PB + f" SELECT cluster, batch, gene_id, {rnd('cnt / n_cells')} AS prop FROM pb JOIN nc USING (cluster, batch) WHERE cnt / n_cells > 1")
def check_proportions(spark, sf):
    from tallyloom.workloads import q_pseudobulk

    pb, _ = q_pseudobulk.pb_table(spark, sf)
    return rounded(checks.proportions(pb.select("cluster", "batch", "gene_id", F.col("mean").alias("prop")), "prop"))


@query("check_good_batches", QC + """, k AS (SELECT batch, COUNT(*) AS n FROM f WHERE keep GROUP BY 1) SELECT COUNT(CASE WHEN n >= 200 THEN 1 END) AS n_good FROM k HAVING COUNT(CASE WHEN n >= 200 THEN 1 END) < 5""")
def check_good_batches(spark, sf):
    from tallyloom.operators import qc

    return checks.enough_good_batches(qc.sample_qc_stats(roles.filtered_cells(spark, sf), roles.cuts(spark, sf)), least=5)


@query("check_constant_within", """SELECT source, 'lang' AS variable, COUNT(DISTINCT lang) AS n_values FROM documents GROUP BY 1 HAVING COUNT(DISTINCT lang) > 1""")
def check_constant_within(spark, sf):
    return checks.constant_within(roles.table(spark, sf, "documents"), "source", ["lang"])


@query("check_unknown_labels", "SELECT label FROM (VALUES ('LARGE'), ('TINY')) t(label) WHERE label NOT IN (SELECT p_type FROM part)")
def check_unknown_labels(spark, sf):
    return checks.unknown_labels(roles.table(spark, sf, "part"), "p_type", ["LARGE", "TINY"])


@query("check_identical_tables", """WITH t AS (SELECT o_orderpriority AS run, list_sort(list(DISTINCT o_orderstatus)) AS v FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') GROUP BY 1),
  m AS (SELECT v FROM t GROUP BY 1 ORDER BY COUNT(*) DESC LIMIT 1) SELECT run FROM t WHERE v <> (SELECT v FROM m)""")
def check_identical_tables(spark, sf):
    """One run lacks a row that the others have."""
    o = roles.table(spark, sf, "orders").where("NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')")
    return checks.identical_tables(o.select(F.col("o_orderpriority").alias("run"), "o_orderstatus").distinct(), "run")

"""Count-table queries: splice sums, totals, moments, normalisation."""

import uuid

from pyspark.sql import functions as F

from tallyloom.operators import counts as C
from tallyloom.operators import hvg, joins, ordered
from tallyloom.session import ensure_checkpoint_dir
from tallyloom.sources import sinks
from tallyloom.workloads import roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import X, rnd


@query("splice_sum", X + " SELECT cell_id, gene_id, SUM(n) AS count FROM g GROUP BY 1, 2")
def splice_sum(spark, sf):
    return C.sum_splice(roles.cell_counts(spark, sf))


@query("split_bind_features", """SELECT l_partkey AS gene_id, CASE l_returnflag WHEN 'R' THEN 'S' WHEN 'N' THEN 'U' ELSE 'A' END AS splice,
  SUM(l_quantity) AS count FROM lineitem GROUP BY 1, 2""")
def split_bind_features(spark, sf):
    b = roles.barcodes(spark, sf).select("run_id", "barcode", F.col("gene_id").cast("string"), "splice", "count")
    parts = [b.where(F.col("splice") == t).drop("splice") for t in ("S", "U", "A")]
    back = C.split_features(C.bind_splice_assays(*parts))
    return back.groupBy(F.col("gene_id").cast("long").alias("gene_id"), "splice").agg(F.sum("count").alias("count"))


@query("usa_totals", """SELECT l_orderkey AS barcode,
  SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS "pre_S",
  SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS "pre_U",
  SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS "pre_A" FROM lineitem GROUP BY 1""")
def usa_totals(spark, sf):
    li = roles.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("barcode"), roles._splice().alias("splice"), F.col("l_quantity").alias("count"))
    return C.usa_totals(li)


_POST = "WHERE l_linestatus = 'F'"


@query("barcode_qc_metrics", f"""WITH a AS (SELECT l_orderkey AS barcode,
  SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS "pre_S", SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS "pre_U",
  SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS "pre_A" FROM lineitem GROUP BY 1),
  p AS (SELECT l_orderkey AS barcode,
  SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS "post_S", SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS "post_U",
  SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS "post_A" FROM lineitem {_POST} GROUP BY 1)
  SELECT * FROM a LEFT JOIN p USING (barcode)""")
def barcode_qc_metrics(spark, sf):
    li = roles.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("barcode"), roles._splice().alias("splice"), F.col("l_quantity").alias("count"), "l_linestatus")
    return C.barcode_qc_metrics(li, li.where(F.col("l_linestatus") == "F"))


@query("min_umi_barcodes", """SELECT l_orderkey AS barcode,
  SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS "pre_S", SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS "pre_U",
  SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS "pre_A" FROM lineitem GROUP BY 1 HAVING SUM(l_quantity) >= 10""")
def min_umi_barcodes(spark, sf):
    return C.min_umi_barcodes(usa_totals(spark, sf), 10)


@query("drop_empty_barcodes", """WITH k AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) > 0)
  SELECT o_orderpriority AS run_id, COUNT(*) AS n_rows FROM lineitem JOIN k USING (l_orderkey) JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def drop_empty_barcodes(spark, sf):
    b = roles.barcodes(spark, sf).withColumn("count", F.when(F.col("splice") == "U", F.col("count")).otherwise(0.0))
    return C.drop_empty_barcodes(b).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("drop_rrna_genes", X + """ SELECT batch, COUNT(*) AS n_rows, SUM(q) AS total FROM x JOIN part ON gene_id = p_partkey
  WHERE p_type <> 'ECONOMY' GROUP BY 1""")
def drop_rrna_genes(spark, sf):
    kept = C.drop_rrna_genes(roles.counts(spark, sf), roles.genes(spark, sf), [roles.RRNA])
    return kept.groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("count").alias("total"))


@query("exclude_mito", X + """ SELECT batch, COUNT(DISTINCT cell_id) AS n_cells, SUM(q) AS total FROM x JOIN part ON gene_id = p_partkey
  WHERE p_name NOT LIKE 'red %' GROUP BY 1""")
def exclude_mito(spark, sf):
    kept = C.exclude_mito(roles.counts(spark, sf), roles.genes(spark, sf))
    return kept.groupBy("batch").agg(F.countDistinct("cell_id").alias("n_cells"), F.sum("count").alias("total"))


@query("keep_genes", X + """ SELECT gene_id, SUM(q) AS total FROM x WHERE gene_id IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1""")
def keep_genes(spark, sf):
    wanted = roles.genes(spark, sf).where(F.col("start") > 25)
    return C.keep_genes(roles.cell_counts(spark, sf), wanted).groupBy("gene_id").agg(F.sum("count").alias("total"))


@query("gene_totals", X + f""" , t AS (SELECT gene_id, SUM(n) AS total, COUNT(*) AS n_expressed FROM g GROUP BY 1)
  SELECT gene_id, total, n_expressed, {rnd('n_expressed / (SELECT SUM(n_cells) FROM cells)')} AS prop_expressed,
  {rnd('total / (SELECT SUM(total) FROM t) * 1e6')} AS cpm FROM t""")
def gene_totals(spark, sf):
    n = roles.n_cells(spark, sf).agg(F.sum("n_cells")).scalar()
    return rounded(C.gene_totals(C.sum_splice(roles.cell_counts(spark, sf)), n))


_MV = X + """, mv0 AS (SELECT batch, gene_id, n_cells, SUM(n) AS s, SUM(n * n) AS sq FROM g JOIN cells USING (batch) GROUP BY 1, 2, 3),
mv AS (SELECT batch, gene_id, n_cells, s / n_cells AS mean, (sq - n_cells * (s / n_cells) * (s / n_cells)) / (n_cells - 1) AS variance FROM mv0)"""


@query("gene_mean_var", _MV + f" SELECT batch, gene_id, n_cells, {rnd('mean')} AS mean, {rnd('variance')} AS variance FROM mv")
def gene_mean_var(spark, sf):
    return rounded(C.gene_mean_var(roles.gene_sums(spark, sf), roles.n_cells(spark, sf)))


@query("gene_mean_var_complete", _MV + f""", grid AS (SELECT p_partkey AS gene_id, batch, n_cells FROM part, cells)
  SELECT batch, gene_id, n_cells, {rnd('coalesce(mean, 0)')} AS mean, {rnd('coalesce(variance, 0)')} AS variance
  FROM grid LEFT JOIN mv USING (batch, gene_id, n_cells)""")
def gene_mean_var_complete(spark, sf):
    mv = C.gene_mean_var(roles.gene_sums(spark, sf), roles.n_cells(spark, sf))
    full = joins.complete(mv, ["gene_id"], ["batch", "n_cells"], {"mean": 0.0, "variance": 0.0},
                          row_values=roles.genes(spark, sf))
    return rounded(full)


_CL = _MV + ", clip AS (SELECT batch, gene_id, 2 * mean + 20 AS clip_val FROM mv)"


@query("clipped_sums", _CL + f""" SELECT batch, gene_id, {rnd('SUM(least(n, clip_val))')} AS counts_sum,
  {rnd('SUM(least(n, clip_val) * least(n, clip_val))', 4)} AS squared_counts_sum FROM g JOIN clip USING (batch, gene_id) GROUP BY 1, 2""")
def clipped_sums(spark, sf):
    gs = roles.gene_sums(spark, sf)
    mv = C.gene_mean_var(gs, roles.n_cells(spark, sf))
    out = C.clipped_sums(gs, mv.withColumn("clip_val", 2.0 * F.col("mean") + 20.0))
    return out.select("batch", "gene_id", F.round("counts_sum", 6).alias("counts_sum"),
                      F.round("squared_counts_sum", 4).alias("squared_counts_sum"))


def _bucketed(spark, sf):
    name = f"counts_{uuid.uuid4().hex}"
    return sinks.write_bucketed_counts(roles.counts(spark, sf), name, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")


@query("bucketed_mean_var", _MV + f" SELECT batch, gene_id, n_cells, {rnd('mean')} AS mean, {rnd('variance')} AS variance FROM mv")
def bucketed_mean_var(spark, sf):
    return rounded(C.gene_mean_var(_bucketed(spark, sf), roles.n_cells(spark, sf)))


@query("bucketed_clipped_sums", _CL + f""" SELECT batch, gene_id, {rnd('SUM(least(n, clip_val))')} AS counts_sum,
  {rnd('SUM(least(n, clip_val) * least(n, clip_val))', 4)} AS squared_counts_sum FROM g JOIN clip USING (batch, gene_id) GROUP BY 1, 2""")
def bucketed_clipped_sums(spark, sf):
    gs = _bucketed(spark, sf)
    mv = C.gene_mean_var(gs, roles.n_cells(spark, sf))
    out = C.clipped_sums(gs, mv.withColumn("clip_val", 2.0 * F.col("mean") + 20.0))
    return out.select("batch", "gene_id", F.round("counts_sum", 6).alias("counts_sum"),
                      F.round("squared_counts_sum", 4).alias("squared_counts_sum"))


@query("library_sizes", X + " SELECT batch, cell_id, SUM(n) AS lib_size FROM g GROUP BY 1, 2")
def library_sizes(spark, sf):
    return C.library_sizes(roles.counts(spark, sf), ["batch", "cell_id"])


@query("log_normalise", X + f""", l AS (SELECT cell_id, SUM(n) AS lib FROM g GROUP BY 1)
  SELECT cell_id, gene_id, n AS count, {rnd('ln(1 + n / lib * 10000)')} AS logcount FROM g JOIN l USING (cell_id)""")
def log_normalise(spark, sf):
    gs = C.sum_splice(roles.cell_counts(spark, sf))
    return rounded(C.log_normalise(gs, C.library_sizes(gs)))


@query("log_normalise_no_mito", X + f""", l AS (SELECT cell_id, SUM(n) AS lib FROM g JOIN part ON gene_id = p_partkey WHERE p_name NOT LIKE 'red %' GROUP BY 1)
  SELECT cell_id, gene_id, n AS count, {rnd('ln(1 + n / lib * 10000)')} AS logcount FROM g JOIN l USING (cell_id) JOIN part ON gene_id = p_partkey
  WHERE p_name NOT LIKE 'red %'""")
def log_normalise_no_mito(spark, sf):
    gs = C.exclude_mito(C.sum_splice(roles.cell_counts(spark, sf)), roles.genes(spark, sf))
    return rounded(C.log_normalise(gs, C.library_sizes(gs)))


@query("normalise_total", X + f""", l AS (SELECT batch, cell_id, SUM(n) AS lib FROM g GROUP BY 1, 2),
  md AS (SELECT batch, quantile_cont(lib, 0.5) AS target FROM l GROUP BY 1)
  SELECT batch, cell_id, gene_id, n AS count, {rnd('ln(1 + n / lib * target)')} AS normcount
  FROM g JOIN l USING (batch, cell_id) JOIN md USING (batch)""")
def normalise_total(spark, sf):
    return rounded(C.normalise_total(roles.gene_sums(spark, sf), by="batch"))


@query("gene_median_counts", X + f""", nz AS (SELECT batch, gene_id, list(n ORDER BY n) AS v, COUNT(*) AS k FROM g GROUP BY 1, 2),
  h AS (SELECT *, n_cells - k AS z, (n_cells - 1) * 0.9 AS pos FROM nz JOIN cells USING (batch)),
  p AS (SELECT *, CASE WHEN floor(pos) < z THEN 0 ELSE v[CAST(floor(pos) - z AS BIGINT) + 1] END AS a,
  CASE WHEN least(floor(pos) + 1, n_cells - 1) < z THEN 0 ELSE v[CAST(least(floor(pos) + 1, n_cells - 1) - z AS BIGINT) + 1] END AS b FROM h)
  SELECT batch, gene_id, {rnd('a + (b - a) * (pos - floor(pos))')} AS q90 FROM p""")
def gene_median_counts(spark, sf):
    """90th percentile of counts per gene over all cells: zeros enter as a weight, not as rows."""
    gs = roles.gene_sums(spark, sf)
    return rounded(hvg.quantiles_with_zeros(gs, roles.n_cells(spark, sf), {"q90": 0.9}))

"""Ambient-signal queries."""

from pyspark.sql import functions as F

from tallyloom.operators import ambient as A
from tallyloom.session import cut_lineage
from tallyloom.workloads import q_counts, q_ranks, roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import rnd

USA = """WITH a AS (SELECT l_orderkey AS barcode, SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS s0, SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS u0,
  SUM(l_quantity) AS t0, SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS s1, SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS u1,
  SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS t1 FROM lineitem GROUP BY 1)"""


def usa(spark, sf):
    return q_counts.barcode_qc_metrics(spark, sf).na.fill(0.0)


def called(spark, sf):
    return roles.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("barcode"))


@query("ambient_profile", q_ranks.PARAMS + f""", ob AS (SELECT o_orderpriority AS run_id, l_orderkey AS barcode, l_partkey AS gene_id, l_quantity AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  e AS (SELECT ob.run_id, gene_id, SUM(q) AS c FROM ob JOIN flagged USING (barcode) WHERE in_empty_plateau GROUP BY 1, 2),
  w AS (SELECT a.run_id, a.gene_id, coalesce(c, 0) AS r FROM (SELECT DISTINCT run_id, gene_id FROM ob) a LEFT JOIN e USING (run_id, gene_id)),
  f AS (SELECT run_id, r, CAST(COUNT(*) AS DOUBLE) AS nr FROM w GROUP BY 1, 2),
  z AS (SELECT *, row_number() OVER u AS place, lag(r, 1, 0) OVER u AS q, lead(r) OVER u AS t, CASE WHEN lead(r) OVER u = r + 1 THEN lead(nr) OVER u END AS nx
    FROM f WHERE r > 0 WINDOW u AS (PARTITION BY run_id ORDER BY r)),
  fit AS (SELECT run_id, CASE WHEN COUNT(*) > 1 THEN regr_slope(ln(nr / (0.5 * (coalesce(t, 2 * r - q) - q))), ln(r)) ELSE -1 END AS b, SUM(r * nr) AS n, SUM(CASE WHEN r = 1 THEN nr ELSE 0 END) AS n1 FROM z GROUP BY 1),
  y AS (SELECT z.*, r * pow(1 + 1 / r, 1 + b) AS line, (r + 1) * nx / nr AS turing, 1.96 * sqrt((r + 1) * (r + 1) * nx / (nr * nr) * (1 + nx / nr)) AS sd FROM z JOIN fit USING (run_id)),
  s AS (SELECT *, CASE WHEN MIN(CASE WHEN abs(turing - line) > sd AND place = r THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY r) = 1 THEN turing ELSE line END AS s FROM y),
  p0 AS (SELECT run_id, n0, CASE WHEN n0 IS NULL THEN 0 WHEN n IS NULL THEN 1 WHEN n1 = n THEN n / (n + 1) ELSE greatest(n1, 0.5) / n END AS p0
    FROM (SELECT DISTINCT run_id FROM w) LEFT JOIN fit USING (run_id) LEFT JOIN (SELECT run_id, nr AS n0 FROM f WHERE r = 0) USING (run_id))
  SELECT w.run_id, gene_id, round(CASE WHEN w.r = 0 THEN p0 / n0 ELSE (1 - p0) * s / tot END, 9) + 0.0 AS p
  FROM w JOIN p0 USING (run_id) LEFT JOIN (SELECT run_id, r, s, SUM(nr * s) OVER (PARTITION BY run_id) AS tot FROM s) k ON k.run_id = w.run_id AND k.r = w.r""")
def ambient_profile(spark, sf):
    return rounded(A.ambient_profile(roles.barcodes(spark, sf), q_ranks.barcode_table(spark, sf)), 9)


@query("ambient_loglik", f"""WITH x AS (SELECT o_orderpriority AS run_id, l_orderkey AS barcode, l_partkey AS gene_id, SUM(l_quantity) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
  p AS (SELECT run_id, gene_id, SUM(n) / SUM(SUM(n)) OVER (PARTITION BY run_id) AS p FROM x GROUP BY 1, 2)
  SELECT run_id, barcode, CAST(SUM(n) AS BIGINT) AS total, {rnd('SUM(n * ln(p) - lgamma(n + 1)) + lgamma(SUM(n) + 1)')} AS loglik FROM x JOIN p USING (run_id, gene_id) GROUP BY 1, 2""")
def ambient_loglik(spark, sf):
    b = roles.barcodes(spark, sf)
    g = b.groupBy("run_id", "gene_id").agg(F.sum("count").alias("c"))
    t = g.groupBy("run_id").agg(F.sum("c").alias("t"))
    prof = g.join(t, "run_id").select("run_id", "gene_id", (F.col("c") / F.col("t")).alias("p"))
    return rounded(A.profile_loglik(b, prof))


@query("empty_drops")
def empty_drops(spark, sf):
    return A.empty_drops(roles.barcodes(spark, sf), cut_lineage(q_ranks.barcode_table(spark, sf)))


def _decontaminated(spark, sf):
    """Cells = customers grouped by nation, background = counts of lines with open status."""
    cl = roles.clustered_cells(spark, sf)
    x = cut_lineage(roles.cell_counts(spark, sf).join(cl, "cell_id").select(F.col("batch").alias("run_id"), F.col("cell_id").alias("barcode"), "cluster", "gene_id", "count", "splice"))
    empties = x.where("splice = 'A'").groupBy("run_id", "gene_id").agg(F.sum("count").alias("count"))
    clusters = x.select("run_id", "barcode", "cluster").distinct()
    return A.decontaminate(x.select("run_id", "barcode", "gene_id", "count"), clusters, empties)


@query("decontaminate")
def decontaminate(spark, sf):
    return _decontaminated(spark, sf)[1]


@query("decontaminated_counts")
def decontaminated_counts(spark, sf):
    return _decontaminated(spark, sf)[0]


@query("ambient_removed", USA + """ SELECT barcode, t0 AS total_pre, t1 AS total_post,
  round(least(greatest(CASE WHEN t1 = t0 THEN -1e9 WHEN t1 = 0 THEN 1e9 ELSE ln((1 - t1 / t0) / (1 - (1 - t1 / t0))) END, ln(1e-4 / (1 - 1e-4))), ln(0.999 / (1 - 0.999))), 6) + 0.0 AS logit_removed
  FROM a JOIN orders ON barcode = o_orderkey WHERE o_orderstatus = 'F'""")
def ambient_removed(spark, sf):
    return rounded(A.ambient_removed(usa(spark, sf), called(spark, sf)))


@query("spliced_vs_umis", USA + """, l AS (SELECT barcode, 'pre' AS stage, t0 AS total, (s0 + 1) / (s0 + u0 + 2) AS p FROM a UNION ALL SELECT barcode, 'post', t1, (s1 + 1) / (s1 + u1 + 2) FROM a),
  i AS (SELECT barcode FROM a WHERE t0 > 0 ORDER BY t0 DESC, barcode LIMIT 3000), o AS (SELECT o_orderkey AS barcode FROM orders WHERE o_orderstatus = 'F')
  SELECT barcode, stage, total, round(ln(p / (1 - p)), 6) + 0.0 AS logit_s, CASE WHEN barcode IN (SELECT barcode FROM o) THEN 'cell'
  WHEN barcode IN (SELECT barcode FROM i) THEN 'no, used for ambient' ELSE 'no, excluded completely' END AS status FROM l WHERE total > 0""")
def spliced_vs_umis(spark, sf):
    return rounded(A.spliced_vs_umis(usa(spark, sf), called(spark, sf), 3000))


@query("ambient_sample_summary", USA + f""" SELECT o_orderpriority AS sample_id, {rnd('100 * SUM(s0) / SUM(t0)')} AS pre_spliced_pct, {rnd('100 * SUM(s1) / SUM(t1)')} AS post_spliced_pct,
  SUM(t0) AS total, SUM(t0) - SUM(t1) AS removed FROM a JOIN orders ON barcode = o_orderkey GROUP BY 1""")
def ambient_sample_summary(spark, sf):
    runs = roles.table(spark, sf, "orders").select(F.col("o_orderkey").alias("barcode"), F.col("o_orderpriority").alias("sample_id"))
    return rounded(A.ambient_sample_summary(usa(spark, sf).join(runs, "barcode")))

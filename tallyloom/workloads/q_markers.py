"""Differential expression, marker tables and gene-set queries."""

from pyspark.sql import functions as F

from tallyloom.functions import signed_log10
from tallyloom.operators import gsea as G
from tallyloom.operators import markers as M
from tallyloom.operators import joins, ordered
from tallyloom.operators import pseudobulk as P
from tallyloom.session import cut_lineage
from tallyloom.workloads import q_pseudobulk as QP
from tallyloom.workloads import roles
from tallyloom.workloads.q_pseudobulk import MEANS, MIN_CELLS
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import rnd

WELCH = MEANS + """, wx AS (SELECT *, n_samples * mean_logcpm AS sm, coalesce(var_logcpm, 0) * (n_samples - 1) + n_samples * mean_logcpm * mean_logcpm AS sq FROM mn),
wt AS (SELECT gene_id, SUM(sm) AS ts, SUM(sq) AS tq, SUM(n_samples) AS tn FROM wx GROUP BY 1),
w1 AS (SELECT wx.*, tn - n_samples AS k, (ts - sm) / (tn - n_samples) AS om, tq - sq AS oq FROM wx JOIN wt USING (gene_id) WHERE n_nonzero > 0),
w2 AS (SELECT *, greatest(var_logcpm, 0) / n_samples AS a, greatest((oq - k * om * om) / (k - 1), 0) / k AS b FROM w1),
wel AS (SELECT cluster, gene_id, mean_logcpm - om AS diff, (mean_logcpm - om) / sqrt(a + b) AS t, (a + b) * (a + b) / (a * a / (n_samples - 1) + b * b / (k - 1)) AS df
  FROM w2 WHERE n_samples > 1)"""


def welch(spark, sf):
    pb, n = QP.pb_table(spark, sf)
    lc, ok = P.log_cpm(pb, n, min_cells=MIN_CELLS), cut_lineage(P.usable_samples(pb, n, min_cells=MIN_CELLS))
    return M.welch_test(P.mean_log_cpm(lc, ok), ok).where("t IS NOT NULL")


@query("welch_markers", WELCH + f" SELECT cluster, gene_id, {rnd('diff')} AS diff, {rnd('t', 4)} AS t, {rnd('df', 2)} AS df FROM wel WHERE a_ok".replace("WHERE a_ok", "WHERE t IS NOT NULL"))
def welch_markers(spark, sf):
    w = welch(spark, sf)
    return w.select("cluster", "gene_id", (F.round("diff", 6) + F.lit(0.0)).alias("diff"), (F.round("t", 4) + F.lit(0.0)).alias("t"), (F.round("df", 2) + F.lit(0.0)).alias("df"))


@query("welch_p_values")
def welch_p_values(spark, sf):
    return M.with_p_values(welch(spark, sf))


# a p-like value per (nation, customer) to adjust
_P = "SELECT c_nationkey AS cluster, c_custkey AS gene_id, (c_acctbal + 1000) / 11000 AS p FROM customer"


@query("bh_adjust", f"""WITH p AS ({_P}), r AS (SELECT *, COUNT(*) OVER (PARTITION BY cluster) AS n, COUNT(*) OVER (PARTITION BY cluster ORDER BY p) AS k FROM p),
  f AS (SELECT *, least(1, MIN(p * n / k) OVER (PARTITION BY cluster ORDER BY p DESC)) AS fdr FROM r) SELECT cluster, gene_id, {rnd('p')} AS p, {rnd('fdr')} AS fdr FROM f""")
def bh_adjust(spark, sf):
    c = roles.table(spark, sf, "customer").select(F.col("c_nationkey").alias("cluster"), F.col("c_custkey").alias("gene_id"), ((F.col("c_acctbal") + 1000.0) / 11000.0).alias("p"))
    return rounded(ordered.bh_adjust(c, "cluster", "p", "fdr"))


# a marker table made of order lines: cluster = ship year, gene = part
_MK = """WITH mk AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS cluster, l_partkey AS gene_id, any_value(p_name) AS symbol, any_value(p_type) AS gene_type,
  round(avg(l_quantity) - 25.5, 6) / 10 AS "logFC", round(least(1.0, avg(l_discount) * avg(l_tax) * 5), 9) AS "FDR", round(avg(l_discount) * avg(l_tax), 9) AS "PValue",
  COUNT(CASE WHEN l_quantity < 20 THEN 1 END) AS n_zero, COUNT(*) AS n_cl, ln(SUM(l_quantity) + 10) AS logcpm_sel
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def line_markers(spark, sf):
    li = roles.table(spark, sf, "lineitem").select(F.year("l_shipdate").cast("string").alias("cluster"), F.col("l_partkey").alias("gene_id"), "l_quantity", "l_discount", "l_tax")
    m = li.groupBy("cluster", "gene_id").agg(
        (F.round(F.avg("l_quantity") - 25.5, 6) / 10.0).alias("logFC"),
        F.round(F.least(F.lit(1.0), F.avg("l_discount") * F.avg("l_tax") * 5.0), 9).alias("FDR"),
        F.round(F.avg("l_discount") * F.avg("l_tax"), 9).alias("PValue"),
        F.count_if(F.col("l_quantity") < 20).alias("n_zero"), F.count(F.lit(1)).alias("n_cl"),
        F.ln(F.sum("l_quantity") + 10.0).alias("logcpm_sel"))
    return m.join(roles.genes(spark, sf).select("gene_id", "symbol", "gene_type"), "gene_id")


@query("top_markers_tiered", _MK + """, t AS (SELECT *, CASE WHEN "FDR" < 0.01 AND "logFC" > 0 AND n_zero / n_cl <= 0.5 THEN 1 WHEN "FDR" < 0.01 AND "logFC" < 0 THEN 2
  WHEN "FDR" >= 0.01 AND (n_zero / n_cl <= 0.5 OR "logFC" < 0) THEN 3 END AS tier FROM mk),
  r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY tier, abs("logFC") DESC, gene_id) AS i FROM t WHERE tier IS NOT NULL)
  SELECT cluster, gene_id, tier, round("logFC", 6) + 0.0 AS "logFC", round("FDR", 6) + 0.0 AS "FDR", round(n_zero / n_cl, 6) + 0.0 AS prop_zero FROM r WHERE i <= 10""")
def top_markers_tiered(spark, sf):
    return rounded(M.top_markers(line_markers(spark, sf)).select("cluster", "gene_id", "tier", "logFC", "FDR", "prop_zero"))


@query("show_markers", _MK + """, r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY "PValue", "logFC" DESC, gene_id) AS i FROM mk
  WHERE NOT regexp_matches(gene_type, '(lincRNA|lncRNA|pseudogene)') AND "FDR" < 0.05 AND "logFC" > 0 AND logcpm_sel > ln(51)),
  s AS (SELECT *, exp(logcpm_sel) - 1 AS v FROM r WHERE i <= 10)
  SELECT cluster, symbol, round(CASE WHEN v = 0 THEN 0 ELSE round(round(v / pow(10, floor(log10(abs(v))) - 1), 9), 0) * pow(10, floor(log10(abs(v))) - 1) END) + 0.0 AS "CPM",
  round("logFC", 1) + 0.0 AS log2fc, round(CASE WHEN "FDR" = 0 THEN 0 ELSE round(round("FDR" / pow(10, floor(log10("FDR")) - 1), 9), 0) * pow(10, floor(log10("FDR")) - 1) END, 6) + 0.0 AS "FDR" FROM s""")
def show_markers(spark, sf):
    return rounded(M.show_markers(line_markers(spark, sf), max_fdr=0.05))


@query("filter_biotype", _MK + """ SELECT cluster, gene_id FROM mk WHERE NOT regexp_matches(gene_type, '(PROMO|SMALL)') AND logcpm_sel >= ln(60) AND (n_zero / n_cl <= 0.3 OR "logFC" < 0)""")
def filter_biotype(spark, sf):
    import math

    return M.filter_biotype(line_markers(spark, sf), "(PROMO|SMALL)", math.log(60), 0.3).select("cluster", "gene_id")


@query("signed_significance", _MK + """ SELECT cluster, gene_id, round(CASE WHEN "PValue" > 0 THEN log10("PValue") END * sign("logFC"), 6) + 0.0 AS score FROM mk""")
def signed_significance(spark, sf):
    m = line_markers(spark, sf)
    return rounded(M.by_signed_significance(m).select("cluster", "gene_id", signed_log10("PValue", "logFC").alias("score")))


@query("selected_genes", _MK + """, w AS (SELECT symbol, row_number() OVER (ORDER BY symbol DESC) AS ord FROM (SELECT DISTINCT p_name AS symbol FROM part WHERE p_name LIKE 'small %'))
  SELECT ord, symbol, gene_type, cluster, round(round(round(v / pow(10, floor(log10(abs(v))) - 1), 9), 0) * pow(10, floor(log10(abs(v))) - 1)) + 0.0 AS "CPM", round("logFC", 1) + 0.0 AS log2fc,
  round(CASE WHEN "FDR" = 0 THEN 0 ELSE round(round("FDR" / pow(10, floor(log10("FDR")) - 1), 9), 0) * pow(10, floor(log10("FDR")) - 1) END, 6) + 0.0 AS "FDR"
  FROM (SELECT *, exp(logcpm_sel) - 1 AS v FROM mk JOIN w USING (symbol))""")
def selected_genes(spark, sf):
    from pyspark.sql import Window

    s = roles.genes(spark, sf).where(F.col("symbol").startswith("small ")).select("symbol").distinct()
    s = s.withColumn("ord", F.row_number().over(Window.orderBy(F.col("symbol").desc())).cast("long"))
    return rounded(M.selected_genes(line_markers(spark, sf), s))


@query("top_labels_to_annotate", _MK + """, u AS (SELECT * FROM mk WHERE "logFC" > 0 AND cluster = (SELECT max(cluster) FROM mk))
  SELECT gene_id FROM (SELECT gene_id FROM u ORDER BY "logFC" DESC, gene_id LIMIT 10) UNION SELECT gene_id FROM (SELECT gene_id FROM u ORDER BY "PValue", gene_id LIMIT 10)""")
def top_labels_to_annotate(spark, sf):
    m = line_markers(spark, sf)
    last = m.agg(F.max("cluster")).scalar()
    return M.top_labels_to_annotate(m.where(F.col("cluster") == last), 10).select("gene_id")


@query("fdr_boundary", _MK + """ SELECT round(MAX(CASE WHEN "FDR" <= 0.05 THEN "PValue" END), 9) + 0.0 AS p_in, round(MIN(CASE WHEN "FDR" > 0.05 THEN "PValue" END), 9) + 0.0 AS p_out,
  round((MAX(CASE WHEN "FDR" <= 0.05 THEN "PValue" END) + MIN(CASE WHEN "FDR" > 0.05 THEN "PValue" END)) / 2, 9) + 0.0 AS p_line FROM mk""")
def fdr_boundary(spark, sf):
    return rounded(M.fdr_boundary(line_markers(spark, sf), 0.05), 9)


@query("heatmap_table", _MK + """, x AS (SELECT * FROM mk WHERE gene_id IN (SELECT p_partkey FROM part WHERE p_size > 40)),
  t AS (SELECT symbol FROM x GROUP BY 1 HAVING MAX(logcpm_sel) >= ln(220))
  SELECT gene_id, symbol, cluster, round("logFC", 6) + 0.0 AS log2fc, CASE WHEN logcpm_sel < ln(211) OR "FDR" > 0.05 OR "logFC" < 0 THEN ''
  WHEN "FDR" > 0.01 THEN '*' WHEN "FDR" > 0.001 THEN '**' ELSE '***' END AS signif FROM x WHERE symbol IN (SELECT symbol FROM t)""")
def heatmap_table(spark, sf):
    panel = roles.genes(spark, sf).where("start > 40")
    return rounded(M.heatmap_table(line_markers(spark, sf), panel, min_cpm=210, pseudo=10))


@query("marker_panel", """WITH a AS (SELECT 'hvgs' AS geneset, p_partkey AS gene_id FROM part WHERE p_size > 10 ORDER BY p_retailprice DESC, p_partkey LIMIT 50),
  b AS (SELECT 'ambient' AS geneset, p_partkey AS gene_id FROM part WHERE p_type = 'PROMO' ORDER BY p_size DESC, p_partkey LIMIT 50)
  SELECT p_brand AS geneset, p_partkey AS gene_id FROM part WHERE p_name LIKE 'red %' UNION ALL SELECT * FROM a UNION ALL SELECT * FROM b""")
def marker_panel(spark, sf):
    p = roles.table(spark, sf, "part")
    custom = p.where(F.col("p_name").startswith("red ")).select(F.col("p_brand").alias("label"), F.col("p_partkey").alias("gene_id"))
    hv = p.select(F.col("p_partkey").alias("gene_id"), (F.col("p_size") > 10).alias("highly_variable"), F.col("p_retailprice").alias("variances_norm"))
    am = p.select(F.col("p_partkey").alias("gene_id"), (F.col("p_type") == "PROMO").alias("is_ambient"), F.col("p_size").alias("logFC"))
    return M.marker_panel(custom, hv, am)


@query("gene_panel_expression", QP.OK + """ SELECT cluster, batch, gene_id, round(logcpm, 6) + 0.0 AS logcpm, printf('%s (%.2e)', p_name, CAST(p_size AS DOUBLE)) AS label, cluster = 'cl03' AS is_selected
  FROM lc JOIN part ON gene_id = p_partkey WHERE p_name LIKE 'red %'""")
def gene_panel_expression(spark, sf):
    pb, n = QP.pb_table(spark, sf)
    g = roles.genes(spark, sf).where("is_mito")
    return rounded(M.gene_panel_expression(P.log_cpm(pb, n, min_cells=MIN_CELLS), g, "start", "cl03"))


@query("smoothed_order", _MK + """, d AS (SELECT cluster, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS p, log10(SUM(exp(logcpm_sel))) AS v FROM mk JOIN part ON gene_id = p_partkey GROUP BY 1, 2),
  s AS (SELECT a.cluster, a.p, SUM(exp(-0.5 * pow((b.p - a.p) / (0.3706506 * 3), 2)) * b.v) / SUM(exp(-0.5 * pow((b.p - a.p) / (0.3706506 * 3), 2))) AS sc
  FROM d a JOIN d b ON a.cluster = b.cluster AND abs(a.p - b.p) <= 5 GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(sc, 9) DESC, p) AS i FROM s) SELECT cluster, p AS position, round(sc, 6) + 0.0 AS smooth_score FROM r WHERE i = 1""")
def smoothed_order(spark, sf):
    m = line_markers(spark, sf).join(roles.genes(spark, sf).select("gene_id", "chromosome"), "gene_id")
    d = m.groupBy("cluster", F.regexp_extract("chromosome", "([0-9]+)", 1).cast("int").alias("position")).agg(
        F.log10(F.sum(F.exp("logcpm_sel"))).alias("log10cpm"))
    return rounded(M.smoothed_order(d, bandwidth=3.0))


@query("nb_ql_markers")
def nb_ql_markers(spark, sf):
    pb, n = QP.pb_table(spark, sf)
    ok = cut_lineage(P.usable_samples(pb, n, min_cells=MIN_CELLS))
    return M.nb_ql_test(pb.join(ok.select("cluster", "batch"), ["cluster", "batch"], "left_semi"), ok)


@query("marker_genes")
def marker_genes(spark, sf):
    pb, n = QP.pb_table(spark, sf)
    return M.markers_from_pseudobulk(cut_lineage(pb), cut_lineage(n), roles.genes(spark, sf), MIN_CELLS)


@query("ambient_genes")
def ambient_genes(spark, sf):
    """Empty side: lines of open orders per segment; cell side: all finished ones."""
    from tallyloom.operators import counts as C

    li = roles.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("gene_id"), F.col("l_quantity").alias("count"), "l_linestatus")
    o = roles.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cell_id"))
    x = li.join(o, "l_orderkey").join(roles.cell_batches(spark, sf), "cell_id").withColumnRenamed("batch", "sample_id")
    pb = cut_lineage(C.sum_splice(x, ("l_linestatus", "sample_id", "gene_id")))
    return M.ambient_genes(pb.where("l_linestatus = 'F'").drop("l_linestatus"), pb.where("l_linestatus = 'O'").drop("l_linestatus"))


_SETS = "SELECT p_brand AS pathway, p_name || '_' || CAST(p_partkey AS VARCHAR) AS symbol FROM part"


def gene_sets(spark, sf):
    return roles.table(spark, sf, "part").select(F.col("p_brand").alias("pathway"), F.concat_ws("_", "p_name", F.col("p_partkey").cast("string")).alias("symbol"))


def _unique_markers(spark, sf):
    return line_markers(spark, sf).withColumn("symbol", F.concat_ws("_", "symbol", F.col("gene_id").cast("string")))


@query("gsea_ranks", _MK + """, sy AS (SELECT *, CASE WHEN gene_id % 7 = 0 THEN symbol ELSE symbol || '_' || CAST(gene_id AS VARCHAR) END AS name FROM mk),
  lf AS (SELECT MIN(CASE WHEN "FDR" > 0 THEN "FDR" END) AS m FROM mk),
  u AS (SELECT cluster, name FROM sy GROUP BY 1, 2 HAVING COUNT(*) = 1)
  SELECT cluster, name AS symbol, round(-(CASE WHEN "FDR" > 0 THEN log10("FDR") ELSE log10(m) - 1 END) * sign("logFC"), 6) + 0.0 AS stat FROM sy JOIN u USING (cluster, name), lf""")
def gsea_ranks(spark, sf):
    """A seventh of the genes keep a symbol that others share; the rest get one of their own."""
    name = F.when(F.col("gene_id") % 7 == 0, F.col("symbol")).otherwise(F.concat_ws("_", "symbol", F.col("gene_id").cast("string")))
    return rounded(G.gsea_ranks(line_markers(spark, sf).withColumn("symbol", name)))


GS = _MK + f""", lf AS (SELECT MIN(CASE WHEN "FDR" > 0 THEN "FDR" END) AS m FROM mk),
rk AS (SELECT cluster, symbol || '_' || CAST(gene_id AS VARCHAR) AS symbol, round(-(CASE WHEN "FDR" > 0 THEN log10("FDR") ELSE log10(m) - 1 END) * sign("logFC"), 9) + 0.0 AS stat FROM mk, lf),
pl AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY stat DESC, symbol) AS pos, COUNT(*) OVER (PARTITION BY cluster) AS ng FROM rk),
st AS (SELECT DISTINCT * FROM ({_SETS})),
hs AS (SELECT cluster, pathway, pos, ng, abs(stat) AS w, row_number() OVER v AS i, SUM(abs(stat)) OVER v AS cw,
  COUNT(*) OVER (PARTITION BY cluster, pathway) AS size, SUM(abs(stat)) OVER (PARTITION BY cluster, pathway) AS nr
  FROM pl JOIN st USING (symbol) WINDOW v AS (PARTITION BY cluster, pathway ORDER BY pos ROWS UNBOUNDED PRECEDING)),
dv AS (SELECT *, round(cw / nr - (pos - i) / (ng - size), 12) AS top, round((cw - w) / nr - (pos - i) / (ng - size), 12) AS low FROM hs WHERE size BETWEEN 5 AND 500),
ge AS (SELECT cluster, pathway, size, ng, MAX(top) AS hi, MIN(low) AS lo FROM dv GROUP BY 1, 2, 3, 4),
pk AS (SELECT cluster, pathway, MIN(CASE WHEN top = hi THEN i END) AS at_hi, MIN(CASE WHEN low = lo THEN i END) AS at_lo FROM dv JOIN ge USING (cluster, pathway, size, ng) GROUP BY 1, 2)"""


def _es(spark, sf):
    r = G.gsea_ranks(_unique_markers(spark, sf)).withColumn("stat", F.round("stat", 9) + F.lit(0.0))
    return r, G.enrichment_scores(r, gene_sets(spark, sf))


@query("gsea_es", GS + f""" SELECT cluster, pathway, size, ng AS n_genes, {rnd('CASE WHEN hi >= -lo THEN hi ELSE lo END')} AS es,
  CAST(CASE WHEN hi >= -lo THEN at_hi ELSE size - at_lo + 1 END AS BIGINT) AS n_leading FROM ge JOIN pk USING (cluster, pathway)""")
def gsea_es(spark, sf):
    es = _es(spark, sf)[1]
    return rounded(es.withColumn("n_leading", F.size("leading_edge").cast("long")).drop("leading_edge"))


@query("gsea")
def gsea(spark, sf):
    """Sets = brands, and for each cluster its 20 highest symbols and, as a set inside it, the first 10 of them."""
    r = cut_lineage(_es(spark, sf)[0])
    top = [joins.first_per_group(r, "cluster", [F.col("stat").desc(), F.col("symbol").asc()], n).select(
        F.concat(F.lit(f"top {n} of "), F.col("cluster").cast("string")).alias("pathway"), "symbol") for n in (20, 10)]
    sets = cut_lineage(gene_sets(spark, sf).unionByName(top[0]).unionByName(top[1]))
    out = G.collapse_pathways(cut_lineage(G.gsea(r, sets)), r, sets)
    return out.withColumn("leading_edge", F.array_join("leading_edge", ","))


@query("gsea_top", _MK + """, r AS (SELECT cluster, p_brand AS pathway, round(least(1, avg("FDR") * 10), 6) AS padj, round(SUM("logFC"), 7) AS nes, COUNT(*) AS size
  FROM mk JOIN part ON gene_id = p_partkey GROUP BY 1, 2),
  m AS (SELECT *, nes > -3 AS main_path FROM r),
  b AS (SELECT pathway FROM m WHERE main_path AND nes > 0 GROUP BY 1 HAVING MIN(padj) < 0.13),
  t AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY padj, pathway) AS i FROM m WHERE main_path AND nes > 0 AND pathway IN (SELECT pathway FROM b) AND size BETWEEN 10 AND 100000),
  s AS (SELECT DISTINCT pathway FROM t WHERE i <= 3)
  SELECT cluster, pathway, padj + 0.0 AS padj, nes + 0.0 AS nes, size, main_path, round(log10(padj), 7) + 0.0 AS log_p, lower(pathway) AS path_name, substr(lower(pathway), 1, 7) AS path_short,
  CASE WHEN padj < 0.13 THEN 'significant' ELSE 'not' END AS signif FROM m WHERE pathway IN (SELECT pathway FROM s)""")
def gsea_top(spark, sf):
    m = line_markers(spark, sf).join(roles.genes(spark, sf).select("gene_id", F.col("chromosome").alias("pathway")), "gene_id")
    r = m.groupBy("cluster", "pathway").agg(F.round(F.least(F.lit(1.0), F.avg("FDR") * 10.0), 6).alias("padj"),
                                            F.round(F.sum("logFC"), 7).alias("nes"), F.count(F.lit(1)).alias("size"))
    r = r.withColumn("main_path", F.col("nes") > -3)
    return rounded(G.gsea_top(r, 3, 0.13, (10, 100000), True, 7), 7)

"""Sample-tag queries on event types per user."""

from pyspark.sql import functions as F

from tallyloom.operators import checks, demux, joins
from tallyloom.workloads import roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import rnd

TAGS = """WITH t AS (SELECT 'pool' || CAST(user_id % 3 AS VARCHAR) AS pool_id, user_id AS cell_id, event_type AS hto_id, COUNT(*) AS count FROM events GROUP BY 1, 2, 3),
nc AS (SELECT pool_id, COUNT(DISTINCT cell_id) AS n FROM t GROUP BY 1),
gm AS (SELECT pool_id, hto_id, exp(SUM(ln(1 + count)) / n) AS g FROM t JOIN nc USING (pool_id) GROUP BY pool_id, hto_id, n),
cl AS (SELECT t.*, ln(1 + count / g) AS norm_count FROM t JOIN gm USING (pool_id, hto_id)),
tg AS (SELECT DISTINCT pool_id, hto_id FROM t), ce AS (SELECT DISTINCT pool_id, cell_id FROM t),
fl AS (SELECT pool_id, cell_id, hto_id, coalesce(count, 0) AS count FROM ce JOIN tg USING (pool_id) LEFT JOIN t USING (pool_id, cell_id, hto_id))"""


@query("clr_tags", TAGS + f" SELECT pool_id, cell_id, hto_id, count, {rnd('norm_count')} AS norm_count FROM cl")
def clr_tags(spark, sf):
    return rounded(demux.clr_normalise(roles.tag_counts(spark, sf)))


@query("tag_props", TAGS + f""" SELECT pool_id, cell_id, hto_id, count, {rnd('norm_count')} AS norm_count, CAST(SUM(count) OVER (PARTITION BY pool_id, cell_id) AS BIGINT) AS hto_total,
  {rnd('count / SUM(count) OVER (PARTITION BY pool_id, cell_id)')} AS prop FROM cl""")
def tag_props(spark, sf):
    return rounded(demux.hto_long(roles.tag_counts(spark, sf)))


@query("tag_complete", TAGS + " SELECT pool_id, cell_id, hto_id, CAST(count AS DOUBLE) AS count FROM fl")
def tag_complete(spark, sf):
    return demux.complete_tags(roles.tag_counts(spark, sf))


@query("tag_median_check", TAGS + """ SELECT pool_id, hto_id, CAST(median(count) AS DOUBLE) AS median_count, hto_id <> 'error' AS expected,
  CASE WHEN median(count) < 14 AND hto_id <> 'error' THEN 'error' WHEN median(count) < 14 THEN 'drop' ELSE 'ok' END AS status FROM fl GROUP BY 1, 2""")
def tag_median_check(spark, sf):
    t = roles.tag_counts(spark, sf)
    want = t.select("pool_id", "hto_id").where("hto_id <> 'error'").distinct()
    return demux.check_tags(t, want, 14.0)


@query("tag_signal_check", TAGS + " SELECT pool_id, hto_id FROM fl GROUP BY 1, 2 HAVING median(count) < 1")
def tag_signal_check(spark, sf):
    t = roles.tag_counts(spark, sf)
    return checks.tag_signal(t, t.select("pool_id", "hto_id")).select("pool_id", "hto_id")


@query("tag_pairs", TAGS + """ SELECT a.pool_id, a.cell_id, a.hto_id AS hto_id_x, b.hto_id AS hto_id_y, a.count AS x, b.count AS y
  FROM t a JOIN t b ON a.pool_id = b.pool_id AND a.cell_id = b.cell_id AND a.hto_id > b.hto_id""")
def tag_pairs(spark, sf):
    return joins.pair_rows(roles.tag_counts(spark, sf), ["pool_id", "cell_id"], "hto_id", "count")


@query("hto_demux")
def hto_demux(spark, sf):
    return demux.hto_demux(roles.tag_counts(spark, sf))


def _guess(spark, sf):
    """Best tag by count, class by the lead over the second best."""
    t = roles.tag_counts(spark, sf)
    best = t.groupBy("pool_id", "cell_id").agg(F.min_by("hto_id", F.struct(-F.col("count"), F.col("hto_id"))).alias("guess"),
                                               F.max("count").alias("m"), F.sum("count").alias("s"))
    share = F.col("m") / F.col("s")
    return best.select("pool_id", "cell_id", "guess", F.when(share > 0.3, "singlet").when(share > 0.25, "doublet").otherwise("negative").alias("demux_class"))


GUESS = TAGS + """, gs AS (SELECT pool_id, cell_id, arg_min(hto_id, (-count, hto_id)) AS guess, MAX(count) / SUM(count) AS sh FROM t GROUP BY 1, 2),
dm AS (SELECT pool_id, cell_id, guess, CASE WHEN sh > 0.3 THEN 'singlet' WHEN sh > 0.25 THEN 'doublet' ELSE 'negative' END AS demux_class FROM gs)"""


@query("hto_summary", GUESS + f" SELECT pool_id, guess, COUNT(*) AS n, {rnd('100 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY pool_id)')} AS pct FROM dm GROUP BY 1, 2")
def hto_summary(spark, sf):
    return rounded(demux.hto_summary(_guess(spark, sf)))


@query("hto_class_table", GUESS + """ SELECT pool_id, COUNT(CASE WHEN demux_class = 'singlet' THEN 1 END) AS singlet, COUNT(CASE WHEN demux_class = 'doublet' THEN 1 END) AS doublet,
  COUNT(CASE WHEN demux_class = 'negative' THEN 1 END) AS negative FROM dm GROUP BY 1""")
def hto_class_table(spark, sf):
    return demux.class_table(_guess(spark, sf))


@query("attach_demux", GUESS + """, ac AS (SELECT c_custkey AS cell_id, 'pool' || CAST(c_custkey % 3 AS VARCHAR) AS pool_id FROM customer),
  j AS (SELECT ac.cell_id, ac.pool_id, coalesce(demux_class, 'negative') AS demux_class, coalesce(guess, 'Negative') AS hto_id FROM ac LEFT JOIN dm USING (cell_id, pool_id))
  SELECT *, hto_id IN ('view', 'click') AND pool_id <> 'pool2' AS valid_hto FROM j""")
def attach_demux(spark, sf):
    cells = roles.table(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), F.concat(F.lit("pool"), (F.col("c_custkey") % 3).cast("string")).alias("pool_id"))
    valid = roles.tag_counts(spark, sf).select("hto_id", "pool_id").where("hto_id IN ('view', 'click') AND pool_id <> 'pool2'").distinct()
    return demux.attach_demux(cells, _guess(spark, sf), valid)


@query("singlet_filter", GUESS + """ SELECT pool_id, cell_id, demux_class = 'singlet' AND guess <> 'error' AND cell_id IN (SELECT doc_id FROM labels WHERE toxic = 0) AS is_single,
  NOT cell_id IN (SELECT doc_id FROM labels WHERE toxic = 0) OR demux_class = 'doublet' AS is_double FROM dm""")
def singlet_filter(spark, sf):
    from tallyloom.operators import qc

    ok = roles.table(spark, sf, "labels").where("toxic = 0").select(F.col("doc_id").alias("cell_id"))
    x = joins.membership_flag(_guess(spark, sf), ok, ["cell_id"], "_ok").withColumns({
        "scdbl_class": F.when(F.col("_ok"), "singlet").otherwise("doublet"), "valid_hto": F.col("guess") != "error"})
    return x.select("pool_id", "cell_id", qc.singlet_predicate("hto", True).alias("is_single"), qc.doublet_predicate("hto", True).alias("is_double"))

"""Barcode-rank queries."""

from pyspark.sql import functions as F

from tallyloom.operators import joins, pseudobulk, qc, ranks
from tallyloom.workloads import roles
from tallyloom.workloads.registry import query, rounded
from tallyloom.workloads.sql_parts import BC, rnd

# Lower bounds that suit totals of a few hundred.
LOWERS = (100, 90, 80, 70, 60, 50, 40, 30, 20, 10)
MIN_UMIS = 5


def knee_sql(points: str, keys: str, name: str, skip: int = 50) -> str:
    """CTEs that give (keys, shin, knee) from a points table with total and rank."""
    on = f"USING ({keys})"
    return f"""
{name}_s AS (SELECT *, log10(rank) AS x, log10(total) AS y,
  (lead(log10(total)) OVER w - log10(total)) / (lead(log10(rank)) OVER w - log10(rank)) AS slope
  FROM {points} WINDOW w AS (PARTITION BY {keys} ORDER BY rank)),
{name}_r AS (SELECT {keys}, total AS rt, rank AS rr, x AS rx, y AS ry FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
  ORDER BY CASE WHEN rank > {skip} THEN 0 ELSE 1 END, CASE WHEN rank > {skip} THEN slope ELSE -rank END, rank) AS i
  FROM {name}_s WHERE slope IS NOT NULL) WHERE i = 1),
{name}_l AS (SELECT {keys}, rt, rr, rx, ry, x AS lx, y AS ly, rank AS lr FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
  ORDER BY slope DESC, rank) AS i FROM {name}_s JOIN {name}_r {on}
  WHERE slope IS NOT NULL AND rank <= rr AND (rank > {skip} OR rank = rr)) WHERE i = 1),
{name}_k AS (SELECT {keys}, rt AS shin, total AS knee FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY
  round(y - CASE WHEN rx > lx THEN ly + (x - lx) * (ry - ly) / (rx - lx) ELSE y END, 9) DESC, rank) AS i
  FROM {name}_s JOIN {name}_l {on} WHERE rank BETWEEN lr AND rr) WHERE i = 1)"""


CURVE = BC + ", curve AS (SELECT run_id, total, n, cum, CAST(cum - n + (n + 1) / 2.0 AS DOUBLE) AS rank FROM r)"
FIRST = CURVE + f""", p1 AS (SELECT run_id, lower, total, rank FROM curve, (SELECT unnest({list(LOWERS)}) AS lower) WHERE total > lower),
""" + knee_sql("p1", "run_id, lower", "f") + """,
first_knee AS (SELECT run_id, shin AS shin1, knee AS knee1, votes FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY votes DESC,
  CAST(shin AS VARCHAR) || '_' || CAST(knee AS VARCHAR)) AS i FROM (SELECT run_id, shin, knee, COUNT(*) AS votes FROM f_k GROUP BY 1, 2, 3)) WHERE i = 1),
k1 AS (SELECT first_knee.*, rank AS shin1_x FROM first_knee JOIN curve ON first_knee.run_id = curve.run_id AND shin1 = total)"""
SECOND = FIRST + f""", seqd AS (SELECT ranks.*, row_number() OVER (PARTITION BY run_id ORDER BY total DESC, barcode) AS i FROM ranks),
lastx AS (SELECT run_id, rank AS last_x FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY total) AS i FROM curve WHERE total > {MIN_UMIS}) WHERE i = 3),
mid AS (SELECT run_id, shin1_x, pow(10, avg(log10(i))) AS middle FROM seqd JOIN k1 USING (run_id) JOIN lastx USING (run_id)
  WHERE seqd.rank BETWEEN shin1_x AND last_x GROUP BY 1, 2),
cuts AS (SELECT run_id, c AS cut_no, shin1_x * pow(10, log10(middle / shin1_x) / 9.0 * c) AS cut FROM mid, (SELECT unnest(range(10)) AS c)),
p2a AS (SELECT run_id, cut_no, total, rank, cum - n AS bf FROM curve JOIN cuts USING (run_id) WHERE rank > cut AND total > {MIN_UMIS}),
p2 AS (SELECT run_id, cut_no, total, rank - min(bf) OVER (PARTITION BY run_id, cut_no) AS rank FROM p2a),
""" + knee_sql("p2", "run_id, cut_no", "s") + """,
st AS (SELECT run_id, shin FROM (SELECT run_id, shin, row_number() OVER (PARTITION BY run_id ORDER BY COUNT(*) DESC, CAST(shin AS VARCHAR)) AS i
  FROM s_k GROUP BY 1, 2) WHERE i = 1),
sm AS (SELECT s_k.*, median(knee) OVER (PARTITION BY run_id) AS med FROM s_k JOIN st USING (run_id, shin)),
k2 AS (SELECT sm2.run_id, shin AS shin2, knee AS knee2, rank AS knee2_x FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY abs(knee - med), cut_no) AS i FROM sm) sm2
  JOIN curve ON sm2.run_id = curve.run_id AND knee = total WHERE i = 1)"""
PARAMS = SECOND + """, inc AS (SELECT run_id, CAST(round(pow(10, avg(log10(i)))) AS BIGINT) AS total_droplets_included
  FROM seqd JOIN k1 USING (run_id) JOIN k2 USING (run_id) WHERE seqd.rank BETWEEN shin1_x AND knee2_x GROUP BY 1),
params AS (SELECT run_id, knee1, shin1, shin1_x, knee2, knee2_x, shin2, shin1_x AS expected_cells, total_droplets_included, shin2 AS low_count_threshold
  FROM k1 JOIN k2 USING (run_id) JOIN inc USING (run_id)),
est AS (SELECT run_id, pow(10, avg(log10(i))) AS es FROM seqd JOIN params USING (run_id) WHERE seqd.rank BETWEEN shin1_x AND total_droplets_included GROUP BY 1),
flagged AS (SELECT ranks.*, coalesce(ranks.rank BETWEEN es AND knee2_x, false) AS in_empty_plateau, knee1, shin1, knee2, shin2, expected_cells,
  total_droplets_included, low_count_threshold FROM ranks JOIN params USING (run_id) JOIN est USING (run_id))"""


def _curve(spark, sf):
    return ranks.rank_curve(roles.barcode_totals(spark, sf))


def _knees(curve):
    k1 = ranks.first_knee(curve, LOWERS)
    return k1.drop("votes").join(ranks.second_knee(curve, k1, MIN_UMIS), "run_id")


@query("barcode_ranks", BC + " SELECT run_id, barcode, total, spliced, unspliced, rank FROM ranks")
def barcode_ranks(spark, sf):
    return ranks.barcode_ranks(roles.barcode_totals(spark, sf))


@query("knee_curve", CURVE + " SELECT run_id, total, n, cum, rank FROM curve")
def knee_curve(spark, sf):
    return _curve(spark, sf)


@query("first_knee", FIRST + " SELECT run_id, shin1, knee1, votes, shin1_x FROM k1")
def first_knee(spark, sf):
    return ranks.first_knee(_curve(spark, sf), LOWERS)


@query("second_knee", SECOND + " SELECT run_id, shin2, knee2, knee2_x FROM k2")
def second_knee(spark, sf):
    curve = _curve(spark, sf)
    return ranks.second_knee(curve, ranks.first_knee(curve, LOWERS), MIN_UMIS)


@query("droplet_params", PARAMS + " SELECT * FROM params")
def droplet_params(spark, sf):
    curve = _curve(spark, sf)
    return ranks.droplet_params(curve, _knees(curve))


@query("barcode_table", PARAMS + """ SELECT run_id, total, barcode, spliced, unspliced, rank, in_empty_plateau, knee1, shin1, knee2, shin2, expected_cells,
  total_droplets_included, low_count_threshold FROM flagged""")
def barcode_table(spark, sf):
    return ranks.barcode_table(roles.barcode_totals(spark, sf), LOWERS, MIN_UMIS)


@query("call_cells_by_rank", PARAMS + """ SELECT run_id, barcode, total FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY total DESC, barcode) AS i
  FROM flagged) WHERE i <= expected_cells""")
def call_cells_by_rank(spark, sf):
    return ranks.call_cells_by_rank(barcode_table(spark, sf)).select("run_id", "barcode", "total")


@query("empty_profile", PARAMS + """ SELECT o_orderpriority AS run_id, l_partkey AS gene_id, SUM(l_quantity) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN flagged ON l_orderkey = barcode WHERE in_empty_plateau GROUP BY 1, 2""")
def empty_profile(spark, sf):
    return pseudobulk.pseudobulk_empties(roles.barcodes(spark, sf), barcode_table(spark, sf))


@query("cells_vs_empties", PARAMS + f""", u AS (SELECT run_id, barcode, CASE WHEN rank <= expected_cells THEN 'cell' ELSE 'empty' END AS what,
  log10(total) AS a, (spliced + 1) / (spliced + unspliced + 2) AS p FROM flagged WHERE rank <= expected_cells OR in_empty_plateau)
  SELECT run_id, barcode, what, 'no. of UMIs' AS qc_metric, {rnd('a')} AS qc_val FROM u
  UNION ALL SELECT run_id, barcode, what, 'spliced pct.', {rnd('ln(p / (1 - p))')} FROM u""")
def cells_vs_empties(spark, sf):
    return rounded(ranks.cells_vs_empties(barcode_table(spark, sf)))


@query("knee_diagnostics", PARAMS + f""", d AS (SELECT run_id, total_droplets_included, expected_cells, shin1_x, log10(curve.rank) AS x, log10(total) AS y FROM curve JOIN params USING (run_id) WHERE total > 5),
  e AS (SELECT run_id, total_droplets_included, expected_cells, regr_slope(y, x) FILTER (abs(x - log10(shin1_x)) <= 0.15) AS a,
  regr_slope(y, x) FILTER (abs(x - log10(total_droplets_included)) <= 0.15) AS b FROM d GROUP BY 1, 2, 3)
  SELECT run_id, total_droplets_included, expected_cells, {rnd('a')} AS slope_shin1, {rnd('b')} AS slope_total_included,
  {rnd('abs(b) / abs(a)')} AS slope_ratio, {rnd('expected_cells / total_droplets_included')} AS expected_total_ratio FROM e""")
def knee_diagnostics(spark, sf):
    curve = _curve(spark, sf)
    return rounded(ranks.knee_diagnostics(curve, ranks.droplet_params(curve, _knees(curve))))


@query("parameter_lines", PARAMS + """, u AS (SELECT run_id, 'knee1' AS param, CAST(knee1 AS DOUBLE) AS value, 'y' AS axis, 'knee' AS kind FROM params
  UNION ALL SELECT run_id, 'knee2', knee2, 'y', 'knee' FROM params UNION ALL SELECT run_id, 'shin1', shin1, 'y', 'inflection' FROM params
  UNION ALL SELECT run_id, 'shin2', shin2, 'y', 'inflection' FROM params
  UNION ALL SELECT run_id, 'total_droplets_included', total_droplets_included, 'x', 'count' FROM params
  UNION ALL SELECT run_id, 'expected_cells', expected_cells, 'x', 'count' FROM params) SELECT * FROM u""")
def parameter_lines(spark, sf):
    curve = _curve(spark, sf)
    return ranks.parameter_lines(ranks.droplet_params(curve, _knees(curve)))


@query("tukey_outliers", BC + """, q AS (SELECT run_id, quantile_cont(log10(total), 0.25) AS a, quantile_cont(log10(total), 0.75) AS b FROM b GROUP BY 1)
  SELECT run_id, barcode, total, spliced, unspliced, coalesce(log10(total) < a - 1.5 * (b - a) OR log10(total) > b + 1.5 * (b - a), false) AS is_outlier
  FROM b JOIN q USING (run_id)""")
def tukey_outliers(spark, sf):
    return ranks.tukey_outliers(roles.barcode_totals(spark, sf), "total", "run_id")


@query("nearest_snap", CURVE + """ SELECT run_id, want, total, rank FROM (SELECT curve.*, want, row_number() OVER (PARTITION BY run_id ORDER BY abs(total - want), rank) AS i
  FROM curve JOIN (SELECT run_id, avg(total) AS want FROM b GROUP BY 1) USING (run_id)) WHERE i = 1""")
def nearest_snap(spark, sf):
    t = roles.barcode_totals(spark, sf)
    want = t.groupBy("run_id").agg(F.avg("total").alias("want"))
    return joins.nearest(ranks.rank_curve(t).select("run_id", "total", "rank"), want, "run_id", "total", "want", "rank")


@query("interval_join", BC + """, w AS (SELECT run_id, min(total) + 10 AS lo, CASE WHEN run_id = '5-LOW' THEN NULL ELSE CAST(avg(total) AS BIGINT) END AS hi FROM b GROUP BY 1)
  SELECT run_id, lo, hi, COUNT(*) AS n, CAST(SUM(total) AS BIGINT) AS total FROM b JOIN w USING (run_id) WHERE total >= lo AND (hi IS NULL OR total <= hi) GROUP BY 1, 2, 3""")
def interval_join(spark, sf):
    t = roles.barcode_totals(spark, sf)
    w = t.groupBy("run_id").agg((F.min("total") + 10).alias("lo"), F.when(
        F.col("run_id") != "5-LOW", F.bround(F.avg("total")).cast("long")).alias("hi"))
    hit = joins.within_interval(t, w, "run_id", "total", "lo", "hi")
    return hit.groupBy("run_id", "lo", "hi").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))


@query("ambient_run_stats", PARAMS + f""", s AS (SELECT run_id, COUNT(*) AS kept_droplets, MAX(total_droplets_included) AS total_droplets FROM flagged WHERE rank <= expected_cells GROUP BY 1)
  SELECT run_id, total_droplets, kept_droplets, round(kept_droplets / total_droplets * 100, 1) + 0.0 AS pct_kept, kept_droplets / total_droplets > 0.5 AS bad_run FROM s""")
def ambient_run_stats(spark, sf):
    t = barcode_table(spark, sf)
    stats = qc.ambient_run_stats(t.where(F.col("rank") <= F.col("expected_cells")), t, max_prop_kept=0.5)
    return rounded(qc.ambient_exclusions(stats))

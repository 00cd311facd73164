"""Queries of fitted models: negative-binomial and weighted linear ones."""

from pyspark.sql import functions as F

from tallyloom.operators import designs as D
from tallyloom.operators import nb, voom
from tallyloom.operators import pseudobulk as P
from tallyloom.session import cut_lineage
from tallyloom.workloads import q_pseudobulk as QP
from tallyloom.workloads.registry import query, rounded

MIN_CELLS = QP.MIN_CELLS
PHI = 0.1
ROUNDS = 20  # of scoring in the SQL; the fits have converged long before

# every group against the rest: the rows of both sides of (cluster, gene), zeros included
_SIDES = QP.DENSE + """, cls AS (SELECT DISTINCT cluster FROM ok),
sd AS MATERIALIZED (SELECT cls.cluster AS c, dense.cluster = cls.cluster AS own, gene_id AS g, CAST(cnt AS DOUBLE) AS y, CAST(lib_size AS DOUBLE) AS l FROM dense CROSS JOIN cls)"""
_NB = _SIDES + ", b0 AS (SELECT c, own, g, ln(SUM(y) / SUM(l)) AS b FROM sd GROUP BY 1, 2, 3 HAVING SUM(y) > 0)" + "".join(
    f""", b{i + 1} AS MATERIALIZED (SELECT c, own, g, any_value(b) + SUM((y - l * exp(b)) / (1 + {PHI} * l * exp(b))) / SUM(l * exp(b) / (1 + {PHI} * l * exp(b))) AS b
  FROM sd JOIN b{i} USING (c, own, g) GROUP BY 1, 2, 3)""" for i in range(ROUNDS)) + f""",
dv AS (SELECT c, g, SUM(2 * ((CASE WHEN y > 0 THEN y * ln(y / (l * exp(b))) ELSE 0 END) - (y + {1 / PHI}) * (ln(1 + {PHI} * y) - ln(1 + {PHI} * l * exp(b))))) AS deviance
  FROM sd JOIN b{ROUNDS} USING (c, own, g) GROUP BY 1, 2),
ft AS (SELECT dv.c AS cluster, dv.g AS gene_id, exp(i.b) * 1e6 AS cpm_in, exp(o.b) * 1e6 AS cpm_out, deviance
  FROM dv LEFT JOIN b{ROUNDS} i ON i.c = dv.c AND i.g = dv.g AND i.own LEFT JOIN b{ROUNDS} o ON o.c = dv.c AND o.g = dv.g AND NOT o.own)"""


def samples(spark, sf):
    """(pseudobulk of usable samples, their libraries)"""
    pb, n = QP.pb_table(spark, sf)
    ok = cut_lineage(P.usable_samples(pb, n, min_cells=MIN_CELLS))
    return cut_lineage(pb.join(ok.select("cluster", "batch"), ["cluster", "batch"], "left_semi").select("cluster", "batch", "gene_id", "count")), ok


@query("nb_fit", _NB + " SELECT cluster, gene_id, round(cpm_in, 2) + 0.0 AS cpm_in, round(cpm_out, 2) + 0.0 AS cpm_out, round(deviance, 2) + 0.0 AS deviance FROM ft")
def nb_fit(spark, sf):
    """Maximum-likelihood means and deviance of every cluster against the rest, at one dispersion."""
    pb, ok = samples(spark, sf)
    d = D.design(ok, "cluster", ("cluster", "batch"))
    fits = nb.two_group_fits(D.gene_vectors(pb, d), d, ok.schema["cluster"].dataType, phi=PHI, tests=False)
    cpm = lambda c: F.exp(c) * 1e6
    return rounded(fits.select("cluster", "gene_id", cpm("log_rate_in").alias("cpm_in"), cpm("log_rate_out").alias("cpm_out"), "deviance"), 2)


@query("nb_dispersions")
def nb_dispersions(spark, sf):
    """Trended and own dispersion of every gene."""
    pb, ok = samples(spark, sf)
    d = D.design(ok, "cluster", ("cluster", "batch"))
    return nb.dispersions(D.gene_vectors(pb, d), d).select("gene_id", "ave_log_cpm", "bin", "trended", "tagwise")


BINS = 8
_VOOM = QP.DENSE + f""", cls AS (SELECT DISTINCT cluster FROM ok),
sm AS (SELECT avg(log2(CAST(lib_size AS DOUBLE) + 1)) - log2(1e6) AS lift, COUNT(*) AS n FROM ok),
z AS (SELECT cluster, batch, gene_id, CAST(lib_size AS DOUBLE) AS l, log2((cnt + 0.5) / (CAST(lib_size AS DOUBLE) + 1) * 1e6) AS z FROM dense),
gm AS (SELECT gene_id, avg(z) AS ave, round(avg(z) + any_value(lift), 9) AS sx FROM z, sm GROUP BY 1),
sz AS MATERIALIZED (SELECT cls.cluster AS c, z.cluster = cls.cluster AS own, gene_id, l, z FROM z CROSS JOIN cls),
mo AS (SELECT c, own, gene_id, avg(z) AS m, SUM(z * z) - COUNT(*) * avg(z) * avg(z) AS rss FROM sz GROUP BY 1, 2, 3),
sp AS (SELECT c, gene_id, pow(SUM(rss) / (any_value(n) - 2), 0.25) AS sy FROM mo, sm GROUP BY 1, 2),
eg AS (SELECT [{", ".join(f"quantile_cont(sx, {i / BINS})" for i in range(1, BINS))}] AS edges FROM gm),
bn AS (SELECT gene_id, ave, sx, len(list_filter(edges, lambda e: e < sx)) AS bin FROM gm, eg),
cv AS (SELECT c, bin, avg(sx) AS x, avg(sy) AS s FROM sp JOIN bn USING (gene_id) GROUP BY 1, 2),
cn AS (SELECT *, lead(x) OVER w AS x2, lead(s) OVER w AS s2, row_number() OVER w AS i, COUNT(*) OVER (PARTITION BY c) AS k FROM cv WINDOW w AS (PARTITION BY c ORDER BY x)),
pt AS (SELECT sz.c, sz.own, sz.gene_id, z, log2(pow(2, m) * (l + 1)) - log2(1e6) AS f FROM sz JOIN mo ON sz.c = mo.c AND sz.own = mo.own AND sz.gene_id = mo.gene_id),
wt AS (SELECT pt.*, pow(greatest(CASE WHEN f <= x AND i = 1 THEN s WHEN i = k THEN s ELSE s + (s2 - s) * (f - x) / (x2 - x) END, 1e-6), -4) AS w
  FROM pt JOIN cn ON pt.c = cn.c AND ((i = 1 AND f < x) OR (f >= x AND (i = k OR f < x2)))),
ms AS (SELECT c, own, gene_id, SUM(w) AS w, SUM(w * z) / SUM(w) AS m FROM wt GROUP BY 1, 2, 3),
rs AS (SELECT wt.c, wt.gene_id, SUM(wt.w * (z - m) * (z - m)) AS rss FROM wt JOIN ms ON wt.c = ms.c AND wt.own = ms.own AND wt.gene_id = ms.gene_id GROUP BY 1, 2),
vm AS (SELECT i.c AS cluster, i.gene_id, i.m - o.m AS lfc, ave, rss / (n - 2) AS s2, sqrt(1 / i.w + 1 / o.w) AS u, i.w AS w_in, o.w AS w_out
  FROM ms i JOIN ms o ON i.c = o.c AND i.gene_id = o.gene_id AND i.own AND NOT o.own JOIN rs ON rs.c = i.c AND rs.gene_id = i.gene_id JOIN bn ON bn.gene_id = i.gene_id, sm)"""


@query("voom_weights", _VOOM + """ SELECT cluster, gene_id, round(lfc, 6) + 0.0 AS "logFC", round(ave, 6) + 0.0 AS "AveExpr", round(s2, 5) + 0.0 AS s2, round(u, 6) + 0.0 AS unscaled,
  round(w_in, 4) + 0.0 AS w_in, round(w_out, 3) + 0.0 AS w_out FROM vm""")
def voom_weights(spark, sf):
    """Precision weights and the weighted fit of every cluster against the rest."""
    pb, ok = samples(spark, sf)
    x = voom.voom_weights(pb, ok, n_bins=BINS)
    digits = {"logFC": 6, "AveExpr": 6, "s2": 5, "unscaled": 6, "w_in": 4, "w_out": 3}
    return x.select("cluster", "gene_id", *[(F.round(c, n) + F.lit(0.0)).alias(c) for c, n in digits.items()])


@query("voom_test")
def voom_test(spark, sf):
    return voom.voom_test(*samples(spark, sf))

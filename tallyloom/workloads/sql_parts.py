"""Shared beginnings of the SQL counterparts."""

X = """WITH x AS (SELECT c_mktsegment AS batch, o_custkey AS cell_id, l_partkey AS gene_id,
  CASE l_returnflag WHEN 'R' THEN 'S' WHEN 'N' THEN 'U' ELSE 'A' END AS splice, l_quantity AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
g AS (SELECT batch, cell_id, gene_id, SUM(q) AS n FROM x GROUP BY 1, 2, 3),
cells AS (SELECT batch, CAST(COUNT(DISTINCT cell_id) AS BIGINT) AS n_cells FROM x GROUP BY 1)"""

QC = X + """,
per_gene AS (SELECT batch, cell_id, gene_id, SUM(q) AS n,
  SUM(CASE WHEN splice = 'S' THEN q ELSE 0 END) AS s, SUM(CASE WHEN splice = 'U' THEN q ELSE 0 END) AS u
  FROM x GROUP BY 1, 2, 3),
m0 AS (SELECT batch, cell_id,
  SUM(CASE WHEN p_type <> 'ECONOMY' THEN n ELSE 0 END) AS sum,
  COUNT(CASE WHEN p_type <> 'ECONOMY' AND n > 0 THEN 1 END) AS detected,
  SUM(CASE WHEN p_type <> 'ECONOMY' AND p_name LIKE 'red %' THEN n ELSE 0 END) AS subsets_mito_sum,
  COUNT(CASE WHEN p_type <> 'ECONOMY' AND p_name LIKE 'red %' AND n > 0 THEN 1 END) AS subsets_mito_detected,
  SUM(s) AS total_spliced, SUM(u) AS total_unspliced, SUM(n) AS total_w_ribo,
  SUM(CASE WHEN p_type = 'ECONOMY' THEN n ELSE 0 END) AS total_rrna,
  CAST(0 AS DOUBLE) AS total_mt_rrna
  FROM per_gene JOIN part ON gene_id = p_partkey GROUP BY 1, 2),
m AS (SELECT *, log10(sum) AS log_counts, log10(detected) AS log_feats,
  ln(((subsets_mito_sum + 1) / (sum + 2)) / (1 - (subsets_mito_sum + 1) / (sum + 2))) AS logit_mito,
  ln(((total_spliced + 1) / (total_spliced + total_unspliced + 2)) / (1 - (total_spliced + 1) / (total_spliced + total_unspliced + 2))) AS logit_spliced,
  log2((total_spliced + 1) / (total_unspliced + 1)) AS splice_ratio
  FROM m0 WHERE sum > 0),
f AS (SELECT *,
  sum >= 200 AND detected >= 20 AND logit_mito < 0 AS keep_hard,
  sum >= 200 AND detected >= 20 AND logit_mito < 0
  AND sum >= 500 AND detected >= 20 AND logit_mito < ln(0.25 / 0.75) AND logit_spliced < ln(0.6 / (1 - 0.6)) AS keep
  FROM m)"""

BC = """WITH b AS (SELECT o_orderpriority AS run_id, l_orderkey AS barcode, CAST(SUM(l_quantity) AS BIGINT) AS total,
  CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS spliced,
  CAST(SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS BIGINT) AS unspliced
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
t AS (SELECT run_id, total, COUNT(*) AS n FROM b GROUP BY 1, 2),
r AS (SELECT run_id, total, n, CAST(SUM(n) OVER (PARTITION BY run_id ORDER BY total DESC) AS BIGINT) AS cum FROM t),
ranks AS (SELECT b.*, CAST(r.cum - r.n + (r.n + 1) / 2.0 AS DOUBLE) AS rank FROM b JOIN r USING (run_id, total))"""

PB = """WITH x AS (SELECT 'cl' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS cluster, c_mktsegment AS batch,
  o_custkey AS cell_id, l_partkey AS gene_id, l_quantity AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
g AS (SELECT cluster, batch, cell_id, gene_id, SUM(q) AS n FROM x GROUP BY 1, 2, 3, 4),
nc AS (SELECT cluster, batch, COUNT(DISTINCT cell_id) AS n_cells FROM x GROUP BY 1, 2),
pb AS (SELECT cluster, batch, gene_id, SUM(n) AS cnt, COUNT(*) AS n_det FROM g GROUP BY 1, 2, 3)"""


def rnd(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"

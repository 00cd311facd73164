"""Doublet scores: how many of a cell's neighbours are simulated doublets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import counts as C
from tallyloom.operators import embed, ordered
from tallyloom.session import cut_lineage

# Least features of a scored cell and least cells of a scored run.
MIN_FEATS, MIN_CELLS = 100, 100
RATE_PER_CELL = 1e-5  # one percent of doublets per thousand cells


def scored_cells(gene_sums: DataFrame, min_feats: int = MIN_FEATS, min_cells: int = MIN_CELLS, run: str = "run_id") -> DataFrame:
    """Cells with enough features in runs with enough such cells, with the run's size and number."""
    ok = gene_sums.where("count > 0").groupBy(run, "cell_id").agg(F.count(F.lit(1)).alias("_f")).where(F.col("_f") >= min_feats).drop("_f")
    size = ok.groupBy(run).agg(F.count(F.lit(1)).alias("n_run")).where(F.col("n_run") >= min_cells)
    names = size.agg(F.array_sort(F.collect_list(run)).alias("r")).scalar()
    size = size.withColumn("_r", names).withColumn("run_no", F.array_position("_r", F.col(run))).drop("_r")
    return ok.join(size, run)


def simulate_doublets(gene_sums: DataFrame, cells: DataFrame, seed: int = 42, run: str = "run_id") -> DataFrame:
    """Sums of random pairs of cells of a run: every cell gets two random slots, pairs share a slot."""
    def slot(k: int):
        return F.pmod(F.xxhash64("cell_id", F.lit(seed + k)), F.col("n_run"))

    a = cells.select(run, slot(1).alias("s"), F.col("cell_id").alias("a"))
    b = cells.select(run, slot(2).alias("s"), F.col("cell_id").alias("b"))
    pairs = a.join(b, [run, "s"]).where("a <> b").withColumn("sim", F.xxhash64("a", "b", F.lit(seed))).select(run, "sim", F.explode(F.array("a", "b")).alias("cell_id"))
    return gene_sums.join(pairs, [run, "cell_id"]).groupBy(run, "sim", "gene_id").agg(F.sum("count").alias("count"))


def doublet_scores(gene_sums: DataFrame, genes: DataFrame, min_feats: int = MIN_FEATS, min_cells: int = MIN_CELLS,
                   n_dims: int = 20, k: int = 30, rate: float | None = None, seed: int = 42, run: str = "run_id") -> DataFrame:
    """Score and class (singlet / doublet) of every cell; cells that are not tested are singlets.

    Real and simulated cells of all runs share one component space; neighbours stay within the run. In each
    run the cells with the highest scores, as many as the expected rate, are doublets. Cells are told apart
    by run and id together. ``genes`` are the genes of the component space.
    """
    cells = cut_lineage(scored_cells(gene_sums, min_feats, min_cells, run))
    key = lambda kind, name: F.to_json(F.struct(F.lit(kind).alias("k"), F.col(run).cast("string").alias("r"), F.col(name).cast("string").alias("c")))
    real = gene_sums.join(cells.select(run, "cell_id"), [run, "cell_id"], "left_semi").select(
        run, F.lit(False).alias("is_sim"), F.col("cell_id").alias("own_id"), key("real", "cell_id").alias("cell_id"), "gene_id", "count")
    kind = dict(gene_sums.dtypes)["cell_id"]
    sim = simulate_doublets(gene_sums, cells, seed, run).select(
        run, F.lit(True).alias("is_sim"), F.lit(None).cast(kind).alias("own_id"), key("sim", "sim").alias("cell_id"), "gene_id", "count")
    both = cut_lineage(real.unionByName(sim).join(genes.select("gene_id").distinct(), "gene_id", "left_semi"))
    ids = both.select(run, "is_sim", "own_id", "cell_id").distinct()
    logs = C.log_normalise(both.select("cell_id", "gene_id", "count"), C.library_sizes(both))
    emb = embed.components(logs, genes, n_dims=n_dims).join(ids.select("cell_id", run), "cell_id")
    nn = embed.knn(cut_lineage(emb), k, by=run, seed=seed)
    of = ids.select(F.col("cell_id").alias("neighbour"), F.col("is_sim").alias("_sim"))
    score = nn.join(of, "neighbour").groupBy("cell_id").agg((F.count_if("_sim") / F.count(F.lit(1))).alias("dbl_score"))
    score = ids.where(~F.col("is_sim")).join(score, "cell_id").select(run, F.col("own_id").alias("cell_id"), "dbl_score")
    x = ordered.positions(cells.join(score, [run, "cell_id"]), run, "dbl_score", "cell_id", "_pos")
    share = F.lit(rate) if rate is not None else F.col("n_run") * RATE_PER_CELL
    cls = F.when(F.col("_pos") <= F.ceil(F.col("n_run") * share), "doublet").otherwise("singlet")
    tested = x.select(run, "cell_id", "dbl_score", cls.alias("scdbl_class"))
    all_cells = gene_sums.select(run, "cell_id").distinct()
    return all_cells.join(tested, [run, "cell_id"], "left").fillna({"scdbl_class": "singlet"})

"""Gene-set enrichment over ranked genes, for all clusters and sets at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators import designs as D
from tallyloom.operators import joins, ordered
from tallyloom.session import cut_lineage

# Smallest and largest set tested.
MIN_SIZE, MAX_SIZE = 5, 500


def gsea_ranks(markers: DataFrame, var: str = "z_score", cluster: str = "cluster") -> DataFrame:
    """One score per cluster and symbol; symbols that occur twice in a cluster are all left out.

    ``z_score`` is -log10(FDR) with the sign of the change; FDR 0 counts as one decade below the
    smallest FDR seen. ``MIR...HG`` host genes take the name without HG.
    """
    if var == "z_score":
        least = markers.agg(F.min(F.when(F.col("FDR") > 0, F.col("FDR"))).alias("m")).scalar()
        log_fdr = F.when(F.col("FDR") > 0, F.log10(F.when(F.col("FDR") > 0, F.col("FDR")))).otherwise(F.log10(F.col("_least")) - 1.0)
        x = markers.withColumn("_least", least).withColumn("stat", -log_fdr * F.signum("logFC") + F.lit(0.0))
    else:
        x = markers.withColumn("stat", F.col("logFC"))
    one = x.groupBy(cluster, "symbol").agg(F.count(F.lit(1)).alias("_n"), F.max("stat").alias("stat")).where("_n = 1")
    name = F.when(F.col("symbol").rlike("^MIR.+HG$"), F.regexp_replace("symbol", "HG$", "")).otherwise(F.col("symbol"))
    return one.select(cluster, name.alias("symbol"), "stat").where(F.col("stat").isNotNull())


def enrichment_scores(ranks: DataFrame, sets: DataFrame, cluster: str = "cluster", min_size: int = MIN_SIZE,
                      max_size: int = MAX_SIZE) -> DataFrame:
    """Enrichment score per cluster and pathway: largest deviation of the running sum.

    Between two hits the sum only falls, so its extremes sit at the hits or just before them and
    only the hits (at most ``max_size`` per set) are scanned. ``leading_edge`` lists the hits up to
    the peak (or from the trough on).
    """
    placed = ordered.positions(ranks, cluster, "stat", "symbol", "pos", descending=True, bounded=True)
    n = ranks.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_genes"))
    hits = sets.select("pathway", "symbol").distinct().join(placed, "symbol").withColumn("w", F.abs("stat"))
    size = hits.groupBy(cluster, "pathway").agg(F.count(F.lit(1)).alias("size"), F.sum("w").alias("nr")).where(
        F.col("size").between(min_size, max_size))
    w = Window.partitionBy(cluster, "pathway").orderBy("pos")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    j = hits.join(size, [cluster, "pathway"]).join(n, cluster).where("n_genes > size").withColumns({
        "i": F.row_number().over(w), "cw": F.sum("w").over(upto)})
    miss = (F.col("pos") - F.col("i")) / (F.col("n_genes") - F.col("size"))
    # all-zero scores count every hit alike
    share = lambda c: F.when(F.col("nr") > 0, c / F.when(F.col("nr") > 0, F.col("nr")))
    top = F.coalesce(share(F.col("cw")), F.col("i") / F.col("size")) - miss
    low = F.coalesce(share(F.col("cw") - F.col("w")), (F.col("i") - 1) / F.col("size")) - miss
    j = j.withColumns({"top": F.round(top, 12), "low": F.round(low, 12)})
    agg = j.groupBy(cluster, "pathway", "size", "n_genes").agg(
        F.max("top").alias("_hi"), F.min("low").alias("_lo"),
        F.max_by("i", F.struct("top", -F.col("i"))).alias("_at_hi"), F.min_by("i", F.struct("low", "i")).alias("_at_lo"),
        F.transform(F.sort_array(F.collect_list(F.struct("i", "symbol"))), lambda s: s["symbol"]).alias("_names"))
    up = F.col("_hi") >= -F.col("_lo")
    edge = F.when(up, F.slice("_names", F.lit(1), F.col("_at_hi"))).otherwise(
        F.reverse(F.slice("_names", F.col("_at_lo"), F.col("size") - F.col("_at_lo") + 1)))
    return agg.select(cluster, "pathway", "size", "n_genes", F.when(up, F.col("_hi")).otherwise(F.col("_lo")).alias("es"),
                      edge.alias("leading_edge"))


def draw_sets(rng: np.random.Generator, many: int, n: int, size: int) -> np.ndarray:
    """``many`` random sets of ``size`` of n positions, sorted, one per row."""
    if 2 * size > n:
        return np.sort(np.argsort(rng.random((many, n)), axis=1)[:, :size], axis=1)
    out = np.sort(rng.integers(0, n, (many, size)), axis=1)
    while True:
        again = np.zeros(out.shape, bool)
        again[:, 1:] = out[:, 1:] == out[:, :-1]
        if not again.any():
            return out
        out[again] = rng.integers(0, n, int(again.sum()))
        out.sort(axis=1)


def deviations(at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest rise above and fall below zero of the running sum of each row of positions ``at``; w: absolute scores by position."""
    n, size = len(w), at.shape[1]
    cw = np.cumsum(w[at], axis=1)
    total = cw[:, -1:]
    hit = np.where(total > 0, cw / np.where(total > 0, total, 1.0), np.arange(1, size + 1) / size)
    miss = (at - np.arange(size)) / (n - size)
    before = np.concatenate([np.zeros((len(at), 1)), hit[:, :-1]], axis=1)
    return (hit - miss).max(1), (before - miss).min(1)


def enrichment(at: np.ndarray, w: np.ndarray) -> np.ndarray:
    high, low = deviations(at, w)
    return np.where(high >= -low, high, low)


TASKS = 100  # slices of jobs


def _by_scores(jobs: DataFrame, ranks: DataFrame, cluster: str, deal: list[str], fit: Callable[[list[dict], np.ndarray], list[dict]], columns: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    """``fit(rows, stats)`` for the rows of ``jobs``, with their cluster's scores from the highest to the lowest.

    A cluster's jobs are dealt by ``deal`` in slices, about TASKS for all clusters. Scores (one per gene of the annotation) go as rows, once to
    each slice, so a task holds the scores of one cluster once, however many jobs there are. ``columns`` of the result: Spark's and Arrow's type; the cluster comes first.
    """
    jobs = cut_lineage(jobs)
    slices = -(-TASKS // max(1, jobs.select(cluster).distinct().count()))
    jobs = jobs.withColumn("_slice", F.pmod(F.xxhash64(*deal), F.lit(slices)).cast("int"))
    stats = ranks.select(cluster, "stat").join(jobs.select(cluster, "_slice").distinct(), cluster).select(cluster, "_slice", "stat").toDF("_cluster", "_part", "stat")

    def run(rows: pa.Table, scores: pa.Table) -> pa.Table:
        kind = pa.schema([rows.schema.field(cluster), *((c, t) for c, (_, t) in columns.items())])
        if not rows.num_rows or not scores.num_rows:
            return kind.empty_table()
        return pa.Table.from_pylist(fit(rows.to_pylist(), np.sort(scores["stat"].to_numpy().astype(float))[::-1]), kind)

    kind = ", ".join([f"`{cluster}` {dict(jobs.dtypes)[cluster]}", *(f"{c} {t}" for c, (t, _) in columns.items())])
    return jobs.groupBy(cluster, "_slice").cogroup(stats.groupBy("_cluster", "_part")).applyInArrow(run, kind)


DRAWS = 1 << 21  # numbers drawn at a time


def null_scores(ranks: DataFrame, sizes: DataFrame, n_perm: int = 1000, chunk: int = 250, seed: int = 42, cluster: str = "cluster") -> DataFrame:
    """Scores of random sets of every size wanted per cluster: (cluster, size, null_es).

    Each task draws ``chunk`` random sets of each size for one cluster from the cluster's sorted score vector.
    """
    want = sizes.select(cluster, F.col("size").cast("long").alias("size")).distinct()
    jobs = want.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit((n_perm - 1) // chunk))))

    def draw(rows: list[dict], stats: np.ndarray) -> list[dict]:
        w, out = np.abs(stats), []
        for r in rows:
            size, part = r["size"], r["part"]
            if size >= len(w):
                continue
            rng = np.random.default_rng([seed, part, size])
            left, found = min(chunk, n_perm - part * chunk), []
            while left > 0:
                many = min(left, max(1, DRAWS // max(size, len(w) if 2 * size > len(w) else 1)))
                found.append(enrichment(draw_sets(rng, many, len(w), size), w))
                left -= many
            out.append({cluster: r[cluster], "size": size, "null_es": np.concatenate(found).tolist()})
        return out

    drawn = _by_scores(jobs, ranks, cluster, ["size", "part"], draw, {"size": ("long", pa.int64()), "null_es": ("array<double>", pa.list_(pa.float64()))})
    return drawn.select(cluster, "size", F.explode("null_es").alias("null_es"))


SAMPLE = 101  # sets in a level; odd, so that the median is one of them
LEAST_P = 1e-50  # smaller p-values are reported as this


def split_levels(w: np.ndarray, size: int, scores: np.ndarray, rng: np.random.Generator, sample: int = SAMPLE, sweeps: float = 1.0, least: float = LEAST_P) -> tuple[np.ndarray, np.ndarray]:
    """P(score >= x and it is the set's larger deviation) for each x of ``scores`` (positive), and the levels that were needed.

    A level keeps the sets whose highest deviation is over the median, copies them over the others, and moves each by
    exchanging one gene at a time, as long as its deviation stays over that median. Half of the
    sets go per level, so the product of the shares that stay is the probability of the last median.
    """
    n = len(w)
    at = draw_sets(rng, sample, n, size)
    row = np.arange(sample)
    high, low = deviations(at, w)
    p, level = np.zeros(len(scores)), np.zeros(len(scores), np.int64)
    open_, reached, depth = np.ones(len(scores), bool), 1.0, 0
    moves = max(50, int(np.ceil(sweeps * size)))
    while True:
        cut = np.median(high)
        stay = high > cut
        last = not stay.any() or reached < least
        for i in np.flatnonzero(open_ & ((scores <= cut) | last)):
            p[i], level[i], open_[i] = reached * ((high >= scores[i]) & (high >= -low)).mean(), depth, False
        if last or not open_.any():
            return p, level
        reached *= stay.mean()
        depth += 1
        source = rng.choice(np.flatnonzero(stay), int((~stay).sum()))
        for x in (at, high, low):
            x[~stay] = x[source]
        for _ in range(moves):
            gene, column = rng.integers(0, n, sample), rng.integers(0, size, sample)
            inside = (at == gene[:, None]).any(1)
            new = at.copy()
            new[row, column] = gene
            new.sort(axis=1)
            up, down = deviations(new, w)
            take = np.flatnonzero(~inside & (up > cut))
            at[take], high[take], low[take] = new[take], up[take], down[take]


def multilevel_p(ranks: DataFrame, wanted: DataFrame, replicates: int = 4, seed: int = 42, cluster: str = "cluster") -> DataFrame:
    """Tail probabilities of rare scores: (cluster, size, es, tail, levels), the mean of ``replicates`` independent runs.

    ``wanted``: cluster, size, es. One task row per cluster, size, sign and replicate splits levels until it has passed
    all scores of that kind. Negative scores are those of the reversed ranks.
    """
    keys = [cluster, "size", "up"]
    jobs = wanted.select(cluster, F.col("size").cast("long").alias("size"), (F.col("es") >= 0).alias("up"), "es").distinct().groupBy(*keys).agg(F.collect_set("es").alias("scores"))
    jobs = jobs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))

    def run(rows: list[dict], stats: np.ndarray) -> list[dict]:
        w, out = np.abs(stats), []
        for r in rows:
            es = np.asarray(r["scores"], float)
            rng = np.random.default_rng([seed, r["part"], r["size"], int(r["up"])])
            p, level = split_levels(w if r["up"] else w[::-1], r["size"], np.abs(es), rng)
            out += [{cluster: r[cluster], "size": r["size"], "es": float(e), "tail": float(x), "levels": int(k)} for e, x, k in zip(es, p, level)]
        return out

    got = _by_scores(jobs, ranks, cluster, ["size", "up", "part"], run, {"size": ("long", pa.int64()), "es": ("double", pa.float64()), "tail": ("double", pa.float64()), "levels": ("long", pa.int64())})
    return got.groupBy(cluster, "size", "es").agg(F.avg("tail").alias("tail"), F.max("levels").alias("levels"))


ENOUGH = 10  # plain draws as extreme as a score, from which their share is kept


def gsea(ranks: DataFrame, sets: DataFrame, n_perm: int = 1000, cluster: str = "cluster", min_size: int = MIN_SIZE,
         max_size: int = MAX_SIZE, replicates: int = 4) -> DataFrame:
    """Enrichment with p-values, normalised scores and adjusted p-values per cluster.

    A score is compared with random sets of its size and sign. Where fewer than ENOUGH of ``n_perm`` plain draws are
    as extreme, the tail comes from ``multilevel_p`` instead. ``log2err`` is the standard error of log2 of the p-value:
    that of a share for plain draws, and that of the levels' beta-distributed shares otherwise.
    """
    es = cut_lineage(enrichment_scores(ranks, sets, cluster, min_size, max_size))
    null = cut_lineage(null_scores(ranks, es.select(cluster, "size"), n_perm, cluster=cluster))
    side = null.groupBy(cluster, "size").agg(
        F.avg(F.when(F.col("null_es") >= 0, F.col("null_es"))).alias("_mp"), F.avg(F.when(F.col("null_es") < 0, -F.col("null_es"))).alias("_mn"),
        F.count_if(F.col("null_es") >= 0).alias("_np"), F.count_if(F.col("null_es") < 0).alias("_nn"))
    more = es.select(cluster, "pathway", "size", "es").join(null, [cluster, "size"]).groupBy(cluster, "pathway").agg(
        F.count_if(F.when(F.col("es") >= 0, F.col("null_es") >= F.col("es")).otherwise(F.col("null_es") <= F.col("es"))).alias("_more"))
    up = F.col("es") >= 0
    same = F.when(up, F.col("_np")).otherwise(F.col("_nn"))
    mean = F.when(up, F.col("_mp")).otherwise(F.col("_mn"))
    j = cut_lineage(es.join(side, [cluster, "size"]).join(more, [cluster, "pathway"]).withColumns({"_same": same, "_mean": mean}).drop("_mp", "_mn", "_np", "_nn"))
    tails = multilevel_p(ranks, j.where(F.col("_more") < ENOUGH).select(cluster, "size", "es"), replicates, cluster=cluster)
    j = j.join(tails.withColumnRenamed("es", "_es"), [*[j[c] == tails[c] for c in (cluster, "size")], j["es"] == F.col("_es"), F.col("_more") < ENOUGH], "left").select(*[j[c] for c in j.columns], "tail", "levels")
    plain = (F.col("_more") + 1.0) / (F.col("_same") + 1.0)
    # the share of draws with the score's sign is what the tail is relative to
    deep = F.least(F.lit(1.0), F.greatest(F.lit(LEAST_P), F.col("tail") * (n_perm + 1.0) / (F.col("_same") + 1.0)))
    one = float(D.trigamma(np.array([(SAMPLE + 1) / 2.0]))[0] - D.trigamma(np.array([SAMPLE + 1.0]))[0])
    rare = F.col("tail").isNotNull()
    err = F.when(rare, F.sqrt((F.col("levels") + 1) * one / replicates)).otherwise(F.sqrt((1 - F.least(plain, F.lit(1.0))) / (F.col("_more") + 1.0))) / float(np.log(2))
    out = j.withColumns({"pval": F.when(rare, deep).otherwise(plain), "log2err": err, "nes": F.col("es") / F.when(F.col("_mean") > 0, F.col("_mean"))})
    return ordered.bh_adjust(out.drop("_same", "_mean", "_more", "tail", "levels"), cluster, "pval", "padj", bounded=True)


def conditional_tests(results: DataFrame, ranks: DataFrame, sets: DataFrame, n_perm: int = 200, cluster: str = "cluster", seed: int = 42) -> DataFrame:
    """For each set p and each other set q that shares genes with it: is q enriched without the genes of p, or among them?

    ``results`` holds the sets to test (cluster, pathway, es). Outside, the genes of p leave the ranks; inside, only
    they stay. Both tests take the sign of q's score, and random sets of the same number of genes from the same genes.
    Columns: cluster, pathway (p), other (q), min_p, the smaller of the two p-values (1 if neither side can be tested).
    """
    placed = ordered.positions(ranks, cluster, "stat", "symbol", "pos", descending=True, bounded=True).select(cluster, "symbol", F.col("pos").cast("int").alias("pos"))
    hits = cut_lineage(sets.select("pathway", "symbol").distinct().join(results.select(cluster, "pathway"), "pathway").join(placed, [cluster, "symbol"]).select(cluster, "pathway", "pos"))
    q = hits.select(cluster, F.col("pathway").alias("other"), "pos")
    pairs = hits.join(q, [cluster, "pos"]).where("pathway <> other").select(cluster, "pathway", "other").distinct()
    genes = hits.groupBy(cluster, "pathway").agg(F.array_sort(F.collect_list("pos")).alias("genes"))
    score = results.select(cluster, F.col("pathway").alias("other"), (F.col("es") >= 0).alias("up"))
    each = pairs.join(genes.withColumnsRenamed({"pathway": "other", "genes": "others"}), [cluster, "other"]).join(score, [cluster, "other"])
    jobs = each.groupBy(cluster, "pathway").agg(F.array_sort(F.collect_list(F.struct("other", "others", "up"))).alias("tests"))
    jobs = jobs.join(genes, [cluster, "pathway"])

    def run(rows: list[dict], stats: np.ndarray) -> list[dict]:
        w, out = np.abs(stats), []
        for r in rows:
            own = np.zeros(len(w), bool)
            own[np.asarray(r["genes"]) - 1] = True
            rng = np.random.default_rng([seed, len(r["genes"]), int(r["genes"][0])])
            least = {t["other"]: 1.0 for t in r["tests"]}
            for part in (~own, own):
                there, place = w[part], np.cumsum(part) - 1
                known: dict[tuple, np.ndarray] = {}
                for t in r["tests"]:
                    at = np.asarray(t["others"]) - 1
                    at = place[at[part[at]]][None]
                    size = at.shape[1]
                    if not 1 <= size < len(there):
                        continue
                    up = bool(t["up"])
                    if (size, up) not in known:
                        null = deviations(draw_sets(rng, n_perm, len(there), size), there)
                        known[size, up] = null[0] if up else -null[1]
                    es = deviations(at, there)
                    es = es[0][0] if up else -es[1][0]
                    least[t["other"]] = min(least[t["other"]], (1 + np.count_nonzero(known[size, up] >= es)) / (n_perm + 1))
            out += [{cluster: r[cluster], "pathway": r["pathway"], "other": o, "min_p": float(p)} for o, p in least.items()]
        return out

    return _by_scores(jobs, ranks, cluster, ["pathway"], run, {"pathway": ("string", pa.string()), "other": ("string", pa.string()), "min_p": ("double", pa.float64())})


def main_sets(order: DataFrame, covers: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Walk the sets of each cluster in their order ``n``; one that no set walked before it covers is walked, and takes in all it covers.

    ``covers``: cluster, pathway, other (taken in by pathway). Returns cluster, pathway, main_path: walked, and not
    taken in by a later one either. The walk is done in rounds over all clusters: a set is decided as soon as
    all earlier ones that cover it are.
    """
    o = order.select(cluster, F.col("pathway").alias("other"), F.col("n").alias("m"))
    links = cut_lineage(covers.join(order.select(cluster, "pathway", "n"), [cluster, "pathway"]).join(o, [cluster, "other"]))
    early = links.where("n < m").select(cluster, "pathway", "other")
    state = cut_lineage(order.select(cluster, "pathway", F.lit(None).cast("boolean").alias("walked")))
    while True:
        above = early.join(state, [cluster, "pathway"]).groupBy(cluster, F.col("other").alias("pathway")).agg(
            F.max(F.coalesce("walked", F.lit(False))).alias("covered"), F.max(F.col("walked").isNull()).alias("waits"))
        new = F.when(F.col("walked").isNotNull(), F.col("walked")).when(F.coalesce("covered", F.lit(False)), False).when(~F.coalesce("waits", F.lit(False)), True)
        state = cut_lineage(state.join(above, [cluster, "pathway"], "left").select(cluster, "pathway", new.alias("walked")))
        if state.where("walked IS NULL").limit(1).count() == 0:
            break
    late = links.where("n > m").join(state.where("walked"), [cluster, "pathway"], "left_semi").select(cluster, F.col("other").alias("pathway"), F.lit(True).alias("_late")).distinct()
    return state.join(late, [cluster, "pathway"], "left").select(cluster, "pathway", (F.col("walked") & F.col("_late").isNull()).alias("main_path"))


def collapse_pathways(results: DataFrame, ranks: DataFrame, sets: DataFrame, cut: float = 0.05, cluster: str = "cluster", n_perm: int | None = None) -> DataFrame:
    """Mark main pathways (``main_path``) among those with padj below ``cut``.

    A significant set is taken in by another one if it is enriched neither without that one's genes nor among
    them (smaller p over ``cut``, from ``n_perm`` random sets, 10 / cut by default). Sets are walked in the order of their p-values. Sets
    without a common gene don't take each other in.
    """
    sig = cut_lineage(results.where(F.col("padj") < cut).select(cluster, "pathway", "pval", "es"))
    order = ordered.positions(sig, cluster, "pval", "pathway", "n", descending=False, bounded=True)
    tests = conditional_tests(sig, ranks, sets, int(round(10 / cut)) if n_perm is None else n_perm, cluster)
    marks = main_sets(order, tests.where(F.col("min_p") > cut), cluster)
    return results.join(marks, [cluster, "pathway"], "left").withColumn("main_path", F.coalesce("main_path", F.lit(False)))


def gsea_top(results: DataFrame, n: int = 10, cut: float = 0.05, size_range: tuple[int, int] = (0, 10**9), positive_only: bool = False,
             n_chars: int = 50, cluster: str = "cluster") -> DataFrame:
    """Pathways shown per cluster: main ones below the cut, first n by adjusted p, with readable names."""
    x = results.where("main_path")
    if positive_only:
        x = x.where("nes > 0")
    best = x.groupBy("pathway").agg(F.min("padj").alias("_m")).where(F.col("_m") < cut)
    x = x.join(best, "pathway", "left_semi").where(F.col("size").between(*size_range))
    top = joins.first_per_group(x, cluster, [F.col("padj").asc(), F.col("pathway").asc()], n).select("pathway").distinct()
    name = F.lower(F.regexp_replace("pathway", "_", " "))
    return results.join(top, "pathway", "left_semi").withColumns({
        "log_p": F.log10(F.coalesce("padj", F.lit(1.0))), "path_name": name, "path_short": F.substring(name, 1, n_chars),
        "signif": F.when(F.coalesce("padj", F.lit(1.0)) < cut, "significant").otherwise("not")})

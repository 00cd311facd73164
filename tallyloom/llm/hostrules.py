"""Quality rules of documents and of their hosts: counts per text, failures per host, rates shrunk by a beta prior."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import arrays as A
from tallyloom.session import cut_lineage

SLICE = 2 << 20
WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
HOT = 1000  # a host with more than one row in so many is hot
LEAST_SPREAD = 1e-6
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _again(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element: is it there twice or more in its row; is it not the first of them."""
    _, first, own, n = np.unique(A.mix(value ^ A.mix(row.astype(A.U64) + A.U64(1))), return_index=True, return_inverse=True, return_counts=True)
    return n[own] > 1, first[own] != np.arange(len(own))


def text_counts(col) -> list[np.ndarray]:
    """The numbers named in COUNTS for each text of an Arrow column; lines and windows are compared by 64-bit fingerprints."""
    buf, offs = A.column_bytes(col)
    n = len(offs) - 1
    w = A.words(buf, offs)
    n_words = np.diff(w.offs)

    def per_row(mark: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(mark) + 1, np.int64)
        np.cumsum(mark, out=sums[1:])
        return sums[ends[1:]] - sums[ends[:-1]]

    chars = per_row((buf & 0xC0) != 0x80, offs) - per_row(A._SPACE[buf], offs)
    symbols = per_row(_SYMBOL[buf], offs)
    # lines: each row's start, and what follows a line feed
    feed = np.flatnonzero(buf == 10)
    begin = np.sort(np.concatenate([offs[:-1], feed + 1]), kind="stable")
    row = np.sort(np.concatenate([np.arange(n), np.searchsorted(offs, feed, "right") - 1]), kind="stable")
    last = np.ones(len(begin), bool)
    last[:-1] = row[1:] != row[:-1]
    end = np.empty(len(begin), np.int64)
    end[:-1] = begin[1:] - 1
    end[last] = offs[1:][row[last]]
    filled = np.searchsorted(w.start, end) > np.searchsorted(w.start, begin)
    begin, end, row = begin[filled], end[filled], row[filled]
    n_lines = np.bincount(row, minlength=n)
    dup = np.zeros(n, np.int64)
    if len(begin):
        dup = np.bincount(row[_again(row, A.byte_prefix(buf).spans(begin, end))[1]], minlength=n)
    cover = np.zeros(len(w.start) + 1, np.int64)
    if len(w.start) >= WINDOW:
        own = A.row_of(w.offs)[: len(w.start) - WINDOW + 1]
        at = np.flatnonzero(np.arange(len(own)) + WINDOW <= w.offs[1:][own])
        twice = at[_again(own[at], A.Prefix(w.value).windows(WINDOW)[at])[0]] if len(at) else at
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + WINDOW, -1)
    repeat = per_row(np.cumsum(cover)[:-1] > 0, w.offs)
    return [n_words, chars, symbols, n_lines, dup, repeat]


def count_texts(docs: DataFrame, keep: Mapping[str, Column]) -> DataFrame:
    """The columns ``keep`` and the numbers of COUNTS for every whole text (null: zeros)."""
    source = docs.select(*[c.alias(k) for k, c in keep.items()], F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.slices(batches, "_text", SLICE):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(x.astype(np.int64)) for x in text_counts(batch.column(batch.num_columns - 1))]], [*batch.schema.names[:-1], *COUNTS])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(run, ", ".join([*kinds, *[f"{c} long" for c in COUNTS]]))


def host_of(source: Column) -> Column:
    """Host of an address (after ``://``, up to ``/``, ``?`` or ``#``), or the whole name where there is none; A-Z lower-cased."""
    name = F.substring_index(source, "://", -1)
    host = F.when(F.instr(source, "://") > 0, F.regexp_extract(name, "^[^/?#]*", 0)).otherwise(source)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def host_rules() -> dict[str, Column]:
    """What counts as a failure of a document towards its host's verdict."""
    return {
        "base": base_failed(),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    }


def shrunk_rates(failures: DataFrame, rules: list[str]) -> DataFrame:
    """Rates per host (host, n, and the failures f_<rule>) drawn towards the mean of all hosts: r_<rule>.

    The prior of a rule is a beta distribution with the hosts' mean and spread: its mean is the share of all rows that
    fail, its strength 1 / spread - 1, where the spread is the part of the variance between hosts that draws
    of n rows don't explain (method of moments, at least LEAST_SPREAD).
    """
    n = F.col("n").cast("double")
    sums = [F.sum(F.col(f"f_{r}")).cast("double").alias(f"k_{r}") for r in rules] + [F.sum(F.col(f"f_{r}").cast("double") * F.col(f"f_{r}") / n).alias(f"q_{r}") for r in rules]
    total = failures.agg(F.count("*").cast("double").alias("hosts"), F.sum(n).alias("rows"), F.sum(n * n).alias("squares"), *sums).first()  # one row
    out = []
    for r in rules:
        mean, strength = beta_prior(total["hosts"], total["rows"] or 0.0, total["squares"] or 0.0, total[f"k_{r}"] or 0.0, total[f"q_{r}"] or 0.0)
        out.append(((F.col(f"f_{r}") + mean * strength) / (n + strength)).alias(f"r_{r}"))
    return failures.select("host", "n", *out)


def beta_prior(hosts: float, rows: float, squares: float, failed: float, spread_sum: float) -> tuple[float, float]:
    """Mean and strength from the numbers of hosts and rows, and the sums of n^2, of failures k and of k^2 / n."""
    mean = failed / rows if rows else 0.0
    noise = mean * (1 - mean)
    left = rows - squares / rows - (hosts - 1) if rows else 0.0
    spread = ((spread_sum - rows * mean * mean) / noise - (hosts - 1)) / left if noise > 0 and left > 0 else 0.0
    return mean, 1 / min(1.0, max(LEAST_SPREAD, spread)) - 1


def judge(docs: DataFrame, host: Column | None = None, limit: float = 0.5) -> DataFrame:
    """Judge documents by their own text, then by their host: most of a host's rows fail a rule, so all of it goes.

    Failures of ``host_rules`` are summed per host; a host is rejected if one of its shrunk rates is over
    ``limit``. A host of few rows is drawn towards the mean, so it is not rejected for one bad row.

    One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, host. ``host``: by default ``host_of`` the column source. A document without host is judged by its own text
    alone, and so are all if there is no column source. Null and empty texts have no words and fail; rows with equal or null ids are
    rows of their own; an empty table gives no rows; other columns are not read.

    The texts are read once and never shuffled; numbers are written once. Hosts with more than one row in HOT, of which there
    are at most HOT, reach their rows by a broadcast, so the rows of no hot host are gathered; the others by a join.
    """
    if host is None:
        host = host_of(F.col("source").cast("string")) if "source" in docs.columns else F.lit(None).cast("string")
    rows = cut_lineage(count_texts(docs, {"doc_id": F.col("doc_id").cast("long"), "host": host}).withColumn("base_failed", base_failed()))
    rules = host_rules()
    failures = rows.where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), *[F.sum(c.cast("long")).alias(f"f_{r}") for r, c in rules.items()])
    bad = F.greatest(*[F.col(f"r_{r}") for r in rules], F.lit(0.0)) > limit
    verdicts = cut_lineage(shrunk_rates(failures, list(rules)).select(F.col("host").alias("_host"), "n", bad.alias("_bad")))
    hot = verdicts.where(F.col("n") * HOT > rows.count()).select("_host", "_bad")
    x = rows.join(F.broadcast(hot), F.col("host") == F.col("_host"), "left").drop("_host")
    cold = verdicts.where("_bad").select("_host").join(F.broadcast(hot.select("_host")), "_host", "left_anti")
    done = x.where("_bad IS NOT NULL OR host IS NULL").withColumn("_bad", F.coalesce("_bad", F.lit(False)))
    rest = x.where("_bad IS NULL AND host IS NOT NULL").drop("_bad").join(cold, F.col("host") == F.col("_host"), "left").withColumn("_bad", F.col("_host").isNotNull()).drop("_host")
    return done.unionByName(rest).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~F.col("_bad")).alias("kept"), "host")

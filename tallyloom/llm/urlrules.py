"""Allow and block rules on hosts and paths by sorted sweeps (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import ensure_checkpoint_dir


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased."""
    raw = F.regexp_extract(url, "^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end."""
    return F.coalesce(F.regexp_extract(url, "^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot: a host and its subdomains are the keys
    from ``org.example.`` up to, but not including, ``org.example/`` (``/`` follows ``.`` in byte order)."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def _sweep(points: DataFrame, marks: DataFrame, keys: list[str], state: str) -> DataFrame:
    """Give each point the state of the last mark at or before it in key order.

    Points and marks are range-partitioned by key together, a row number splitting equal keys, and swept
    in order. A partition starts with the last state of the partitions before it, taken from one row each.
    """
    ensure_checkpoint_dir(points.sparkSession)
    both = points.withColumn(state, F.lit(None).cast(marks.schema[state].dataType)).withColumn("_kind", F.lit(1)).unionByName(
        marks.withColumn("_kind", F.lit(0)), allowMissingColumns=True).withColumn("_row", F.monotonically_increasing_id())
    order = [*keys, "_kind", "_row"]
    placed = both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    lasts = placed.groupBy("_part").agg(F.max_by(state, F.when(F.col("_kind") == 0, F.struct(*order))).alias("_last"))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    carried = lasts.select("_part", F.last("_last", ignorenulls=True).over(ahead).alias("_carried"))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    swept = placed.withColumn("_seen", F.last(state, ignorenulls=True).over(inside)).where("_kind = 1").join(carried, "_part")
    return swept.withColumn(state, F.coalesce("_seen", "_carried")).drop("_seen", "_carried", "_part", "_kind", "_row")


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to ``urls`` (key columns of any kind, and url).

    ``rules`` has host, path and action (allow or block). A rule fits its host and all subdomains when the
    path of the url starts with its path. The longest host + path wins; between equal lengths the longer
    host, then the first in byte order; of rules with one host and path, block wins. Without a fit, rule is
    null and the verdict is ``default``. A null url, or one without ``://``, has an empty host and path.

    First sweep: reversed hosts. Where the interval of a rule's host opens, the stack of active hosts is
    that of the enclosing interval and itself; where it closes, the enclosing one's. Intervals of hosts
    are nested or apart, so one stack per boundary says all, and its depth is the number of labels.
    Second sweep: within each active host, paths in order; a prefix's interval opens at the prefix and
    closes at the least string that is greater than all strings with it; here the top of the stack decides.
    Repeated urls stay repeated rows; extra columns named host, path, rule or verdict are replaced.
    """
    # a rule table is small next to the urls, but nothing here gathers it in one place
    flat = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.max("action").alias("action"))  # 'block' > 'allow'
    hosts = flat.select("host").distinct().withColumn("_open", reversed_host(F.col("host")))

    # enclosing rule hosts of each rule host, outermost first
    labels = F.split(F.regexp_replace("_open", "\\.$", ""), "\\.")
    depth = hosts.select("host", "_open", F.posexplode(F.transform(labels, lambda _, i: F.concat(F.array_join(F.slice(labels, 1, i + 1), "."), F.lit(".")))).alias("_depth", "_outer"))
    chain = depth.join(hosts.select(F.col("host").alias("_name"), F.col("_open").alias("_outer")), "_outer").groupBy("host", "_open").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_depth", "_name"))), lambda x: x["_name"]).alias("_stack"))
    close = F.concat(F.expr("substring(_open, 1, length(_open) - 1)"), F.lit("/"))
    host_marks = chain.select(F.col("_open").alias("_key"), "_stack").unionByName(
        chain.select(close.alias("_key"), F.slice("_stack", 1, F.size("_stack") - 1).alias("_stack")))

    base = urls.drop("host", "path", "rule", "verdict", "_id").withColumn("_id", F.monotonically_increasing_id()).select("*", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    points = base.withColumn("_key", reversed_host(F.col("host")))
    staged = _sweep(points, host_marks, ["_key"], "_stack").drop("_key")

    # second sweep: (rule host, path); the deepest open prefix is the longest rule of that host
    pre = F.expr("sequence(0, length(path))")
    inner = flat.select("host", "path", "action", F.explode(F.transform(pre, lambda n: F.expr("path").substr(F.lit(1), n))).alias("_outer"))
    outer = flat.select("host", F.col("path").alias("_outer"), F.col("action").alias("_outer_action"))
    parents = inner.where("_outer <> path").join(outer, ["host", "_outer"]).groupBy("host", "path").agg(
        F.max_by(F.struct(F.col("_outer").alias("path"), F.col("_outer_action").alias("action")), F.length("_outer")).alias("_parent"))
    ruled = flat.join(parents, ["host", "path"], "left")
    top = F.struct(F.lit(True).alias("known"), F.struct("path", "action").alias("top"))
    opened = ruled.select(F.col("host").alias("_rule_host"), F.col("path").alias("_text"), F.lit(1).alias("_close_len"), top.alias("_top"))
    # closing marks come right after the last path with the prefix: the prefix and the greatest character
    ended = ruled.select(F.col("host").alias("_rule_host"), F.concat("path", F.lit("\U0010FFFF\U0010FFFF")).alias("_text"), (-F.length("path")).alias("_close_len"),
                         F.struct(F.lit(True).alias("known"), F.col("_parent").alias("top")).alias("_top"))
    floor = flat.select(F.col("host").alias("_rule_host")).distinct().select("_rule_host", F.lit("").alias("_text"), F.lit(-1).alias("_close_len"),
                                                                            F.struct(F.lit(True).alias("known"), F.lit(None).cast(opened.schema["_top"].dataType["top"].dataType).alias("top")).alias("_top"))
    # outer prefixes close after inner ones: longer closings first
    marks = floor.unionByName(opened).unionByName(ended)
    tries = staged.select("_id", "path", F.explode("_stack").alias("_rule_host")).select("_id", "_rule_host", F.col("path").alias("_text"), F.lit(2).alias("_close_len"))
    found = _sweep(tries, marks, ["_rule_host", "_text", "_close_len"], "_top").where("_top.top IS NOT NULL")
    size = F.length("_rule_host") + F.length("_top.top.path")
    best = found.groupBy("_id").agg(F.max_by(
        F.struct(F.concat("_rule_host", "_top.top.path").alias("rule"), F.col("_top.top.action").alias("action")),
        F.struct(size, F.length("_rule_host"))).alias("_best"))
    return staged.drop("_stack").join(best, "_id", "left").select(
        *[c for c in base.columns if c != "_id"], F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict"))

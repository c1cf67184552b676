"""Reports: grouped and conditional aggregations over messages, probes, labels and tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import micros

# Bucket bounds of the latency and confidence histograms.
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0)
CONFIDENCE_BUCKETS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """One row: support-weighted precision, recall and F1 (0 where undefined) and accuracy; a null prediction is ``other``."""
    pairs = df.filter(F.col(truth).isNotNull()).groupBy(F.col(truth).cast("string").alias("t"), F.coalesce(F.col(pred).cast("string"), F.lit("other")).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    real = pairs.groupBy(F.col("t").alias("c")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"))
    said = pairs.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("said"))
    per = real.join(said, "c", "left").withColumns({"precision": _share(F.col("hit"), F.coalesce("said", F.lit(0))), "recall": _share(F.col("hit"), F.col("support"))})
    per = per.withColumn("f1", _share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    mean = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    return per.agg(mean("precision"), mean("recall"), mean("f1"), (F.sum("hit") / F.sum("support")).alias("accuracy"))


def latency_report(df: DataFrame, latency: str, ok: Column, by: Sequence[str] = ()) -> DataFrame:
    """Mean, p50, p95, p99, throughput a second of latency (in ms) and success rate.

    p95 is the exclusive quantile (rank 0.95 (n + 1), interpolated), p99 the highest value
    below 100 rows.
    """
    w = Window.partitionBy(*by).orderBy(latency)
    rows = df.select(*by, F.col(latency).alias("x"), ok.cast("int").alias("ok"), F.row_number().over(w).alias("k"), F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("n"))
    rank = 0.95 * (F.col("n") + 1)
    low = F.greatest(F.lit(1), F.least(F.floor(rank), F.col("n") - 1))
    out = rows.groupBy(*by).agg(
        F.avg("x").alias("mean"), F.percentile("x", 0.5).alias("p50"), F.max("n").alias("n"), F.max(F.when(F.col("k") == low, F.col("x"))).alias("a"), F.max(F.when(F.col("k") == low + 1, F.col("x"))).alias("b"),
        F.percentile("x", 0.99).alias("p99_exact"), F.max("x").alias("most"), (F.count(F.lit(1)) / (F.sum("x") / 1000)).alias("throughput"), F.avg("ok").alias("success_rate"))
    low = F.greatest(F.lit(1), F.least(F.floor(0.95 * (F.col("n") + 1)), F.col("n") - 1))
    p95 = F.coalesce(F.col("a") + (0.95 * (F.col("n") + 1) - low) * (F.col("b") - F.col("a")), F.col("most"))
    return out.select(*by, "mean", "p50", p95.alias("p95"), F.when(F.col("n") < 100, F.col("most")).otherwise(F.col("p99_exact")).alias("p99"), "throughput", "success_rate")


def usage_cost(calls: DataFrame, prices: DataFrame, model: str, text: str) -> DataFrame:
    """Calls, tokens (words times 1.3) and cost by model, from a price table (per 1000 tokens)."""
    words = F.when(F.length(F.trim(text)) > 0, F.size(F.split(F.trim(text), r"\s+"))).otherwise(0)
    used = calls.groupBy(model).agg(F.count(F.lit(1)).alias("calls"), F.sum(F.floor(words * 1.3)).alias("tokens"))
    return used.join(prices, model).withColumn("cost", F.col("tokens") / 1000 * F.col("price")).withColumn("cost_per_1k_calls", F.col("cost") / F.col("calls") * 1000).drop("price")


def set_scores(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """Adds precision, recall and F1 of two value arrays, compared trimmed in lower case; two empty sets agree fully."""
    norm = lambda c: F.array_distinct(F.transform(c, lambda x: F.lower(F.trim(x))))
    df = df.withColumns({"_p": norm(pred), "_t": norm(truth)})
    hit = F.size(F.array_intersect("_p", "_t"))
    both_empty = (F.size("_p") == 0) & (F.size("_t") == 0)
    p = F.when(both_empty, 1.0).when(F.size("_p") == 0, 0.0).otherwise(hit / F.size("_p"))
    r = F.when(both_empty, 1.0).when(F.size("_t") == 0, 0.0).otherwise(hit / F.size("_t"))
    df = df.withColumns({"precision": p, "recall": r})
    return df.withColumn("f1", _share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).drop("_p", "_t")


def calibration(df: DataFrame, confidence: str, accuracy: Column, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of confidence and accuracy; 0 where undefined or below two rows."""
    r = F.corr(F.col(confidence), accuracy.cast("double"))
    return df.groupBy(*by).agg(F.when(F.count(F.lit(1)) < 2, 0.0).otherwise(F.coalesce(F.nanvl(r, F.lit(0.0)), F.lit(0.0))).alias("calibration"))


def check_criteria(metrics: DataFrame, criteria: DataFrame) -> DataFrame:
    """Metrics against targets with an operator and a tolerance: ``passed``, ``deviation`` and ``severity``."""
    gap = F.col("value") - F.col("target")
    passed = F.when(F.col("op") == "~", F.abs(gap) <= F.col("tolerance")).when(F.col("op") == "<=", gap <= 0).when(F.col("op") == ">=", gap >= 0).when(F.col("op") == "<", gap < 0).when(F.col("op") == ">", gap > 0)
    out = criteria.join(metrics, "metric", "left").withColumns({"passed": F.coalesce(passed, F.lit(False)), "deviation": _share(F.abs(gap), F.abs(F.col("target")))})
    return out.withColumn("severity", F.when(F.col("passed"), "ok").when(F.col("value").isNull(), "missing").when(F.col("deviation") > 0.1, "critical").otherwise("warning"))


def compare_baselines(current: DataFrame, previous: DataFrame, keys: Sequence[str], limits: DataFrame) -> DataFrame:
    """Change of each metric, in percent too, and whether it is a regression by the metric's limit.

    A limit is the allowed change in percent: negative where the metric may fall so far,
    positive where it may rise so far.  Rows without a partner are ``missing``.
    """
    out = current.withColumnRenamed("value", "now").join(previous.withColumnRenamed("value", "before"), list(keys), "full_outer").join(F.broadcast(limits), "metric", "left")
    pct = F.when(F.col("before") != 0, (F.col("now") - F.col("before")) / F.abs("before") * 100)
    out = out.withColumns({"change": F.col("now") - F.col("before"), "change_pct": pct})
    verdict = F.when(F.col("now").isNull() | F.col("before").isNull(), "missing").when(F.when(F.col("limit") < 0, pct < F.col("limit")).otherwise(pct > F.col("limit")), "regression").when(F.when(F.col("limit") < 0, pct > 0).otherwise(pct < 0), "improvement").otherwise("same")
    return out.withColumn("verdict", verdict).drop("limit")


def assess_change(changes: DataFrame) -> DataFrame:
    """One row: regressions, improvements, critical ones (over 10 %), missing, and the overall verdict."""
    n = lambda c: F.count_if(c)
    reg = F.col("verdict") == "regression"
    out = changes.agg(n(reg).alias("regressions"), n(F.col("verdict") == "improvement").alias("improvements"), n(reg & (F.abs("change_pct") > 10)).alias("critical"), n(F.col("verdict") == "missing").alias("missing"))
    return out.withColumn("overall", F.when(F.col("critical") > 0, "critical").when(F.col("regressions") > 0, "regressed").when(F.col("improvements") > 0, "improved").otherwise("stable"))


def link_stats(health: DataFrame, by: Sequence[str] = (), now: Column | None = None, ts: str = "ts") -> DataFrame:
    """Links by status and health band, and those with failures in the last day; optionally by a key such as the domain.

    With ``now`` also ``retry_due``: quarantined and dead links whose next check is due.
    """
    h, s = F.col("health"), F.col("status")
    due = [] if now is None else [F.count_if(s.isin("quarantined", "dead") & (micros(ts) + F.col("next_check_hours") * 3_600_000_000 <= F.unix_micros(now))).alias("retry_due")]
    return health.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(s == x).alias(x) for x in ("healthy", "suspicious", "quarantined", "dead")],
        F.count_if(h >= 0.8).alias("band_good"), F.count_if((h >= 0.5) & (h < 0.8)).alias("band_fair"), F.count_if((h >= 0.2) & (h < 0.5)).alias("band_poor"), F.count_if(h < 0.2).alias("band_bad"), F.count_if(F.col("failures") > 0).alias("failing"), *due)


def link_health_trend(probes: DataFrame, key: str = "url", ts: str = "ts", order: str = "event_id") -> DataFrame:
    """Failures, recoveries (a success right after a failure) and their net, by day."""
    before = F.lag("success").over(Window.partitionBy(key).orderBy(ts, order))
    rows = probes.withColumn("_r", F.col("success") & ~F.coalesce(before, F.lit(True)))
    out = rows.groupBy(F.date_format(ts, "yyyy-MM-dd").alias("day")).agg(F.count_if(~F.col("success")).alias("failures"), F.count_if("_r").alias("recoveries"))
    return out.withColumn("net", F.col("recoveries") - F.col("failures"))


def link_report(stats: DataFrame, trend: DataFrame | None = None) -> DataFrame:
    """One row of stats with the share of usable links, the system's health and a recommendation, and the sums of a trend's days."""
    if trend is not None:
        sums = trend.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("failures", "recoveries", "net")], F.count(F.lit(1)).alias("days"))
        stats = stats.join(F.broadcast(sums))
    usable = _share(F.col("healthy") + F.col("suspicious"), F.col("total"))
    return stats.withColumn("usable", usable).withColumn("system", F.when(usable >= 0.9, "good").when(usable >= 0.7, "degraded").otherwise("poor")).withColumn("advice", F.when(F.col("dead") > 0, "remove dead links").when(F.col("quarantined") > 0, "recheck quarantined links").otherwise("none"))


def graph_stats(nodes: DataFrame) -> DataFrame:
    """Nodes by label, and coverage: their share of 10 000, at most 1."""
    return nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("coverage", F.least(F.lit(1.0), F.sum("n").over(Window.partitionBy()) / 10_000))


def metric_counters(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Counts by labels with subtotals (a null label is all of it)."""
    return df.rollup(*labels).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level"))


def histogram(df: DataFrame, value: Column, buckets: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative bucket counts ``le_0`` ... in one pass, with sum and count."""
    return df.groupBy(*by).agg(*[F.count_if(value <= b).alias(f"le_{i}") for i, b in enumerate(buckets)], F.sum(value).alias("sum"), F.count(value).alias("count"))


def content_mix(df: DataFrame, kind: str, confidence: Column) -> DataFrame:
    return df.groupBy(kind, (F.floor(confidence * 10) / 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def queue_stats(frontier: DataFrame, capacity: int, started: str | None = None, finished: str | None = None) -> DataFrame:
    """Tasks by status, the share of the capacity that open tasks use, and the mean priority of pending ones.

    With the times that tasks started and finished also ``mean_seconds`` of completed tasks and
    their ``throughput`` a minute, from the first start to the last end (null without any).
    """
    s = F.col("status")
    times = []
    if started and finished:
        a, b = (F.when(s == "completed", micros(c)) for c in (started, finished))
        times = [(F.sum(b - a) / F.count(b - a) / 1e6).alias("mean_seconds"), (F.count(b) * 6e7 / F.nullif(F.max(b) - F.min(a), F.lit(0))).alias("throughput")]
    names = ("pending", "in_progress", "completed", "failed")
    return frontier.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(s == x).alias(x) for x in names], (F.count_if(s.isin("pending", "in_progress")) / capacity).alias("used"), F.avg(F.when(s == "pending", F.col("priority"))).alias("pending_priority"), *times)


def crawl_metrics(decisions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Shares of crawl decisions by reason, with denominators of at least 1."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    r = F.col("reason")
    return decisions.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), (F.count_if(F.col("should_crawl")) / n).alias("crawl_rate"), (F.count_if(r == "cache_hit") / n).alias("cache_hit_rate"), (F.count_if(r == "dedupe_hit") / n).alias("dedupe_rate"))


def trace_summary(spans: DataFrame, ts: str, operation: str, failed: Column, latency: str) -> DataFrame:
    """By hour and operation: calls, errors, mean latency, and whether the error rate passes 20 %.

    Latencies are added up in whole thousandths, so the mean (to four digits, halves up) does
    not depend on the order of addition.
    """
    out = spans.groupBy(F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd HH").alias("hour"), operation).agg(F.count(F.lit(1)).alias("calls"), F.count_if(failed).alias("errors"), F.sum(F.round(F.col(latency) * 1000).cast("long")).alias("_s"), F.count(latency).alias("_n"))
    out = out.withColumn("mean_latency", F.expr("(20 * _s + _n) div (2 * _n)") / 10_000.0).drop("_s", "_n")
    return out.withColumn("breach", F.col("errors") / F.col("calls") > 0.2)


def trace_totals(spans: DataFrame, operation: str, failed: Column, latency: str, cost: Column) -> DataFrame:
    """One row: calls, operations, errors and their rate, mean latency (in whole thousandths, as above) and cost (in whole millionths)."""
    n = F.count(F.lit(1))
    out = spans.groupBy(operation).agg(n.alias("calls"), F.count_if(failed).alias("errors"), F.sum(F.round(F.col(latency) * 1000).cast("long")).alias("_s"), F.count(latency).alias("_n"), F.sum(F.round(cost * 1_000_000).cast("long")).alias("_c"))
    out = out.agg(n.alias("operations"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("calls", "errors", "_s", "_n", "_c")])
    return out.select("operations", "calls", "errors", _share(F.col("errors"), F.col("calls")).alias("error_rate"), (F.expr("(20 * _s + _n) div nullif(2 * _n, 0)") / 10_000.0).alias("mean_latency"), (F.col("_c") / 1_000_000).alias("cost"))


def top_operations(spans: DataFrame, operation: str, failed: Column, k: int) -> DataFrame:
    """The k operations with most calls (ties: the smaller name)."""
    return spans.groupBy(operation).agg(F.count(F.lit(1)).alias("calls"), F.count_if(failed).alias("errors")).orderBy(F.desc("calls"), operation).limit(k)


def route_stats(routed: DataFrame, failed: Column) -> DataFrame:
    """Rows by route and content type, their share of all, and the share of failed ones among them."""
    out = routed.groupBy("route", "content_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("_f"))
    return out.withColumns({"share": F.col("n") / F.sum("n").over(Window.partitionBy()), "error_rate": F.col("_f") / F.col("n")}).drop("_f")


def error_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def cache_distribution(scored: DataFrame, levels: DataFrame, capacity: int) -> DataFrame:
    """Entries by priority level, levels without entries included, and the share of the capacity."""
    counts = scored.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    return levels.join(counts, "level", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("share", F.col("n") / capacity)


def crawl_stats(results: DataFrame, query: str, source: str, extracted: Column) -> DataFrame:
    """Results of each query, their distinct sources, and how many gave content."""
    return results.groupBy(query).agg(F.count(F.lit(1)).alias("results"), F.count_distinct(source).alias("sources"), F.count_if(extracted).alias("extracted"))


def crawl_totals(results: DataFrame, query: str, source: str, extracted: Column) -> DataFrame:
    """One row over all queries; each pair of query and source is counted once before they meet."""
    pairs = results.groupBy(query, source).agg(F.count_if(extracted).alias("_x"))
    return pairs.agg(F.count_distinct(query).alias("queries"), F.count_distinct(source).alias("sources"), F.coalesce(F.sum("_x"), F.lit(0)).alias("extracted"))


def validation_rate(df: DataFrame, kind: str, valid: Column) -> DataFrame:
    return df.groupBy(kind).agg(F.avg(valid.cast("double")).alias("rate"))

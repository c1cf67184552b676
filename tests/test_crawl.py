"""Crawl decisions behind a Bloom filter, and providers asked in turn."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from sentryloom.functions.hooks import fallback_calls
from sentryloom.operators.aggregates import queue_stats, trace_totals
from sentryloom.operators.relations import should_crawl


def test_rows_that_miss_the_filter_skip_the_lookups(spark):
    urls = spark.createDataFrame([("a", True), ("b", True), ("c", True), ("d", True), ("a2", False), (None, None)], "url string, maybe boolean")
    table = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    out = should_crawl(urls, table("a", "a", "a2"), table("a", "b"), table("b", "c"), maybe="maybe", priority=F.lit(0.9))
    got = {r["url"]: (r["reason"], r["should_crawl"], r["priority"]) for r in out.collect()}
    new = ("no_checks_failed", True, 0.9)
    assert out.count() == 6
    assert got == {"a": ("dedupe_hit", False, 0.5), "b": ("cache_hit", False, 0.5), "c": ("graph_hit", False, 0.5), "d": new, "a2": new, None: new}


def test_providers_are_asked_only_for_open_rows(spark):
    def first(rows: pd.DataFrame) -> pd.Series:
        return rows["v"].where(rows["v"] == "x")

    def second(rows: pd.DataFrame) -> pd.Series:
        return (rows["v"] + f"{len(rows[rows['v'] == 'x'])}").where(rows["v"] != "z")

    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None)], "id long, v string").coalesce(1)
    got = {r["id"]: (r["answer"], r["answered_by"]) for r in fallback_calls(df, ("first", first), ("second", second)).collect()}
    assert got == {1: ("x", "first"), 2: ("y0", "second"), 3: (None, None), 4: (None, None)}


def test_empty_tables_give_one_row(spark):
    tasks = spark.createDataFrame([], "status string, priority double, a timestamp, b timestamp")
    row = queue_stats(tasks, 10, "a", "b").first()
    assert (row["total"], row["mean_seconds"], row["throughput"]) == (0, None, None)
    spans = spark.createDataFrame([], "op string, ok boolean, ms double")
    row = trace_totals(spans, "op", ~F.col("ok"), "ms", F.col("ms")).first()
    assert (row["operations"], row["calls"], row["error_rate"], row["mean_latency"]) == (0, 0, 0.0, None)

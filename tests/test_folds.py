"""Folds of hot keys in slices against the fold over all rows of a key, and rolling counts against a range window."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from sentryloom.operators import windows as W

BEGIN = datetime(2024, 1, 1)


def made(spark, seed, gap, n=900, key_type="long"):
    """A key with most rows (or all of its rows at even distances), a null key, some others; ties in time."""
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(n):
        at += gap if rng.random() < 0.97 else rng.randint(0, 3 * gap)
        rows.append((7 if i % 5 else rng.choice([1, 2, None]), i, BEGIN + timedelta(seconds=at), rng.random() < 0.4, rng.choice(["http_404", "timeout", None]), rng.choice([403, 500, None])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, f"k {key_type}, i long, ts timestamp, success boolean, failure_type string, status_code int").repartition(3)


FOLDS = {
    "ttl": lambda d, n: W.dedupe_ttl(d, "k", "ts", "i", 40_000, slice_rows=n).select("i"),
    "sliding": lambda d, n: W.rate_limit_sliding(d, "k", "ts", "i", 3, 40_000, slice_rows=n).select("i", "allowed"),
    "bucket": lambda d, n: W.token_bucket(d, "k", "ts", "i", 4, 70_000, slice_rows=n).select("i", "allowed"),
    "health": lambda d, n: W.health_score(d, "k", "ts", "i", slice_rows=n).select("i", "health", "failures", "permanent_any"),
    "status": lambda d, n: W.link_status(d, "k", "ts", "i", slice_rows=n).select("i", "status", "run", "health", "next_check_hours"),
}


@pytest.mark.parametrize("name", FOLDS)
@pytest.mark.parametrize("gap,slice_rows", [(700, 60), (3600, 25)])
def test_slices_equal_the_whole_fold(spark, name, gap, slice_rows):
    df = made(spark, 3, gap)
    whole, sliced = (sorted(map(tuple, FOLDS[name](df, n).collect())) for n in (10**6, slice_rows))
    assert whole == sliced and whole


def test_a_hot_key_is_spread_and_slices_that_do_not_settle_are_joined(spark, monkeypatch):
    """Rows each hour and a ttl of a day: no slice forgets where it began, and the result is still that of the whole fold."""
    rows = [(1, i, BEGIN + timedelta(hours=i)) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, i long, ts timestamp")
    seen = []
    folded = W._folded
    monkeypatch.setattr(W, "_folded", lambda r, *a: seen.append(r.filter("_enter IS NULL").groupBy("_slice").count().collect()) or folded(r, *a))
    monkeypatch.setattr(W, "SLICE_ROUNDS", 2)
    got = [r.i for r in W.dedupe_ttl(df, "k", "ts", "i", 86_400 - 1_800, slice_rows=50).orderBy("i").collect()]
    assert got == list(range(0, 700, 24))
    assert len(seen[0]) == 14 and all(r["count"] <= 75 for r in seen[0]) and len(seen) < 14
    assert len(seen[-1]) < 14


def test_rolling_counts_equal_a_range_window(spark):
    df = made(spark, 9, 5000)
    got = {r.i: (r.failures, r.permanent, r.permanent_any, r.successes) for r in W.recent_failures(df, 24, "k", "ts").collect()}
    w = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-24 * W.HOUR + 1, 0)
    bad, kind, code = ~F.col("success"), F.col("failure_type").isin(*W.PERMANENT_TYPES), F.col("status_code").isin(*W.PERMANENT_CODES)
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("int")).over(w)
    want = {r.i: (r.a, r.b, r.c, r.d) for r in df.withColumns({"a": count(bad), "b": count(bad & kind), "c": count(bad & (kind | code)), "d": count(F.col("success"))}).collect()}
    assert got == want


def test_empty_and_null_times(spark):
    schema = "k long, i long, ts timestamp, success boolean, failure_type string, status_code int"
    assert W.link_status(spark.createDataFrame([], schema), "k", "ts", "i").collect() == []
    assert [tuple(r) for r in W.recent_failures(spark.createDataFrame([(1, 1, None, False, None, None)], schema), 24, "k", "ts").select("failures", "successes").collect()] == [(0, 0)]

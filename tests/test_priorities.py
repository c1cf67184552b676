"""Priorities from graph tables on rows that lack things."""

from __future__ import annotations

from pyspark.sql import functions as F
from sentryloom.operators import graph as G
from sentryloom.operators.relations import crawl_priorities


def test_containment_of_domains(spark):
    domains = ["a.co", "b", "www.example.com", "example.com", "averylonghost.example.org", "absent.example.net", "", None]
    sources = [("https://www.example.com/feed", 0.5), ("https://a.co/?u=example.com", 0.9), ("https://x.org/averylonghost.example.org/averylonghost.example.org", 1.0), ("https://a.co", None), (None, 0.1)]
    got = {r.domain: (r.known_sources, None if r.reputation is None else round(r.reputation, 6)) for r in G.domain_reputation(spark.createDataFrame([(d,) for d in domains * 2], "domain string"), spark.createDataFrame(sources, "url string, reputation double")).collect()}
    want = {}
    for d in filter(None, domains):
        hits = [r for u, r in sources if u and d in u]
        if hits:
            have = [r for r in hits if r is not None]
            want[d] = (len(hits), round(sum(have) / len(have), 6) if have else None)
    assert got == want


def test_signals_of_odd_rows(spark):
    rows = [(1, "https://www.example.com/x", "2024-01-31 12:00:00", ["old", "new", "new", None, "n2", "n3", "n4"], ["big", "small", "gone", "gone2"]), (2, None, None, None, None), (3, "no host", "2024-01-20 00:00:00", [], [])]
    urls = spark.createDataFrame(rows, "page_id int, url string, published string, indicators array<string>, actors array<string>").withColumn("published", F.to_timestamp("published"))
    sources = spark.createDataFrame([("http://www.example.com", 0.8)], "url string, reputation double")
    indicators = spark.createDataFrame([("old",), (None,)], "value string")
    coverage = G.actor_coverage(spark.createDataFrame([("big", 1), ("small", 2), ("none", 3)], "actor string, indicator int"), spark.createDataFrame([(a, 1) for a in range(6)] + [(1, 2)], "article int, indicator int"))
    assert {r.actor: r.articles for r in coverage.collect()} == {"big": 6, "small": 1, "none": 0}
    out = G.graph_priorities(urls, sources, indicators, coverage, F.lit("2024-02-01 12:00:00").cast("timestamp"))
    got = {r.page_id: (r.known, r.unseen, round(r.gap, 6), r.age_days, round(r.graph_priority, 6)) for r in out.collect()}
    assert got == {1: (True, 4, 0.4, 1, 1.0), 2: (False, 0, 0.0, None, 0.0), 3: (False, 0, 0.0, 12, 0.0)}
    mentioned = spark.createDataFrame([("https://www.example.com/x",)] * 3 + [(None,)], "url string")
    assert {r.page_id: (r.mention_count, round(r.priority, 6)) for r in crawl_priorities(out, mentioned, F.col("age_days") <= 3).collect()} == {1: (3, 1.0), 2: (0, 0.5), 3: (0, 0.5)}

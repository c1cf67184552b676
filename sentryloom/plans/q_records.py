"""Queries of record operators, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import records as C
from ..operators import relations as R
from ..sources.stand_ins import frame
from .q_reports import SCORE, now

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT doc_id, 'https://' || source || '.example.com/x?id=1' AS url, source AS title, lang AS tags FROM documents")
def normalize_feed_records(spark, d):
    rows = frame(spark, d, "documents").select("doc_id", F.concat(F.lit("https://"), F.upper("source"), F.lit(".example.com/x?utm_source=a&id=1#f")).alias("url"), F.concat(F.lit("  "), "source", F.lit(" ")).alias("title"), F.array(F.upper("lang"), F.col("lang")).alias("tags"))
    return C.normalize_feed_records(rows).select("doc_id", "url", "title", F.array_join("tags", ",").alias("tags"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 5 = 0 THEN 'url' END, CASE WHEN length(text) > 500 THEN 'title' END, CASE WHEN length(text) > 5000 THEN 'description' END, CASE WHEN doc_id % 4 = 0 THEN 'cve_ids' END, CASE WHEN doc_id % 3 = 0 THEN 'schema_version' END, CASE WHEN doc_id % 7 = 0 THEN 'record_type' END, CASE WHEN doc_id % 6 = 0 THEN 'confidence' END], lambda x: x IS NOT NULL), ',') AS errors FROM documents")
def validate_feed_records(spark, d):
    i = F.col("doc_id")
    rows = frame(spark, d, "documents").select(
        "doc_id", F.when(i % 5 != 0, "https://a").alias("url"), F.col("text").alias("title"), F.col("text").alias("description"), F.array(F.when(i % 4 == 0, "CVE-24-1").otherwise("CVE-2024-1234")).alias("cve_ids"), F.when(i % 3 == 0, "1.0").otherwise("1.0.0").alias("schema_version"),
        F.array(F.lit("a")).alias("tags"), F.when(i % 7 == 0, "odd").otherwise("raw").alias("record_type"), F.when(i % 6 == 0, 1.5).otherwise(0.5).alias("confidence"))
    return C.validate_feed_records(rows).select("doc_id", F.array_join(F.transform("errors", lambda e: e["path"]), ",").alias("errors"))


@query("SELECT doc_id, (doc_id % 2 = 0 AND length(text) > 300) OR (doc_id % 2 = 1 AND length(text) > 150) AS needs FROM documents")
def needs_summary(spark, d):
    return frame(spark, d, "documents").select("doc_id", C.needs_summary(F.when(F.col("doc_id") % 2 == 0, "Article").otherwise("ThreatActor"), F.col("text")).alias("needs"))


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'fr')")
def filter_feed_kinds(spark, d):
    return C.filter_feed_kinds(frame(spark, d, "documents"), "lang", ("en", "fr")).select("doc_id")


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 4 = 2 THEN epoch_us(ts) ELSE (epoch_us(ts) // 1000000) * 1000000 END AS us FROM events")
def parse_source_date(spark, d):
    ts, i = F.col("ts").cast("timestamp"), F.col("event_id")
    text = F.when(i % 4 == 0, F.unix_seconds(ts).cast("string")).when(i % 4 == 1, F.concat(F.lit("Mon, "), F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(i % 4 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).otherwise("soon")
    return frame(spark, d, "events").select("event_id", F.unix_micros(F.coalesce(C.parse_source_date(text, "misp"), C.parse_source_date(text, "rss"))).alias("us"))


@query("SELECT doc_id, CASE WHEN length(source) < 10 AND doc_id % 2 = 0 THEN 'A better title' ELSE source END AS title, CASE WHEN doc_id % 2 = 0 THEN 'Acme' ELSE lang END AS vendor FROM documents")
def apply_enrichment(spark, d):
    even = F.col("doc_id") % 2 == 0
    rows = frame(spark, d, "documents").select("doc_id", F.col("source").alias("title"), F.col("text").alias("description"), F.col("lang").alias("vendor"), F.struct(F.when(even, "A better title").alias("title"), F.lit("").alias("description"), F.when(even, "Acme").otherwise("").alias("vendor")).alias("enrichment"))
    return C.apply_enrichment(rows).select("doc_id", "title", "vendor")


@query("SELECT event_id, round(0.4 * CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 0.8 ELSE 0 END + 0.3 * (user_id % 5) / 4 + 0.2 * CASE WHEN event_id % 4 = 0 THEN 1 WHEN event_id % 4 = 1 THEN 0.5 WHEN event_id % 4 = 2 THEN 0.9 ELSE 0 END + 0.1 * (1 - abs(0.9 - (user_id % 10) / 10)), 6) AS score FROM events")
def threat_score(spark, d):
    i, u = F.col("event_id"), F.col("user_id")
    rows = frame(spark, d, "events").select(
        "event_id", F.when(i % 3 == 0, "Malware").when(i % 3 == 1, "ransomware").otherwise("phishing").alias("pred_class"), F.lit("malware").alias("true_class"), ((u % 5) / 4).alias("f1"),
        F.when(i % 4 == 0, "apt28").when(i % 4 == 1, "group APT28").when(i % 4 == 2, "Fancy Bear").otherwise("none").alias("pred_actor"), F.lit("APT28").alias("true_actor"), F.lit(0.9).alias("pred_confidence"), ((u % 10) / 10).alias("true_confidence"))
    aliases = spark.createDataFrame([("fancy bear", "apt28"), ("sofacy", "apt28"), ("cozy bear", "apt29")], "name string, actor string")
    return C.threat_score(rows, aliases).select("event_id", F.round("score", 6).alias("score"))


@query("SELECT doc_id, round((CASE WHEN doc_id % 2 = 0 THEN 0.4 + 1.0 / 3 * 2 + 0.5 ELSE 0.2 + 0 + 0 END + 0.8) / 4, 6) AS quality FROM documents")
def reasoning_quality(spark, d):
    first = F.concat(F.lit("zzqx "), "text")
    steps = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("Identified ZZQX; FOUND"), F.lit("-0-"))).otherwise(F.array(F.lit("-0-")))
    plain = F.regexp_replace(first, r"-0-|[-0]", "@@")
    return frame(spark, d, "documents").select("doc_id", F.round(C.reasoning_quality(steps, F.concat(F.lit("zzqx "), F.repeat(F.lit("@@ "), 25), plain)), 6).alias("quality"))


@query(SCORE + " SELECT DISTINCT content_hash FROM l WHERE level IN ('critical', 'high') AND strftime(created_at, '%Y-%m-%d') = '2024-01-20'")
def cache_warm(spark, d):
    entries = R.cache_score(frame(spark, d, "cache_entries"), now())
    return C.cache_warm(entries, entries.select("content_hash", F.col("created_at").alias("ts")), "2024-01-20")


@query()
def duplicate_flag(spark, d):
    docs = frame(spark, d, "documents")
    return C.duplicate_documents(docs.filter("doc_id % 5 = 0"), docs.filter("doc_id % 5 <> 0"), "doc_id", "text")

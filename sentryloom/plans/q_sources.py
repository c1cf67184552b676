"""Queries of parsers, sinks and hooks: payloads are built from the tables and parsed back; the SQL states what must come out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import hooks as H
from ..operators import relations as R
from ..sources import parsers as P
from ..sources.stand_ins import frame, sql_with
from ..streaming.streams import dead_letter

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN user_id END AS user_id FROM events")
def decode_json_lenient(spark, d):
    i = F.col("event_id")
    text = F.when(i % 3 == 0, F.to_json(F.struct("user_id"))).when(i % 3 == 1, F.concat(F.lit("{'user_id': "), "user_id", F.lit("}"))).otherwise("not json")
    return frame(spark, d, "events").select("event_id", F.try_variant_get(P.decode_json_lenient(text), "$.user_id", "bigint").alias("user_id"))


def _feeds(spark, d):
    i = F.col("doc_id")
    rss = F.concat(F.lit("<rss><channel><title>"), "source", F.lit("</title><item><guid>g"), i, F.lit("</guid><title>"), "lang", F.lit("</title><link>https://h/"), i, F.lit("</link><category>a</category><category>b</category></item><item><title>second</title><pubDate>2024</pubDate></item></channel></rss>"))
    atom = F.concat(F.lit("<feed><title>"), "source", F.lit("</title><entry><id>a"), i, F.lit("</id><title>"), "lang", F.lit("</title><link rel=\"self\" href=\"https://self/\"/><link href=\"https://h/"), i, F.lit("\"/><summary>s</summary></entry></feed>"))
    return frame(spark, d, "documents").select("doc_id", "source", F.when(i % 2 == 0, rss).otherwise(atom).alias("xml"))


@query("SELECT doc_id, source AS feed_title, CASE WHEN doc_id % 2 = 0 THEN 'g' || doc_id ELSE 'a' || doc_id END AS entry_id, lang AS title, 'https://h/' || doc_id AS link FROM documents UNION ALL SELECT doc_id, source, md5('second2024'), 'second', NULL FROM documents WHERE doc_id % 2 = 0")
def parse_feed_xml(spark, d):
    return P.parse_feed_xml(_feeds(spark, d), "xml").select("doc_id", "feed_title", "entry_id", "title", "link")


@query("SELECT CASE WHEN doc_id % 2 = 0 THEN 'g' ELSE 'a' END || doc_id AS id, 'https://h/' || doc_id AS url, 'feeds.example.org' AS source_name, CASE WHEN doc_id % 2 = 0 THEN 'a,b' ELSE '' END AS tags FROM documents")
def feed_entry_to_records(spark, d):
    rows = P.parse_feed_xml(_feeds(spark, d), "xml").withColumn("feed", F.lit("https://feeds.example.org/rss"))
    return P.feed_entry_to_records(rows, "feed").select("id", "url", "source_name", F.array_join("tags", ",").alias("tags"))


def _ioc_json(spark, d):
    i = F.col("event_id")
    one = F.to_json(F.struct("value", "type", "comment", "to_ids"))
    text = F.when(i % 4 == 0, F.concat(F.lit("["), one, F.lit("]"))).when(i % 4 == 1, F.concat(F.lit('{"response": ['), one, F.lit(","), one, F.lit("]}"))).when(i % 4 == 2, F.concat(F.lit('{"Attribute": '), one, F.lit("}"))).otherwise(one)
    return frame(spark, d, "indicators").select("event_id", text.alias("body"))


@query(sql_with("indicators") + "SELECT event_id, value, type, comment, to_ids, '' AS category FROM indicators UNION ALL SELECT event_id, value, type, comment, to_ids, '' FROM indicators WHERE event_id % 4 = 1")
def parse_ioc_json(spark, d):
    return P.parse_ioc_json(_ioc_json(spark, d), "body").select("event_id", "value", "type", "comment", "to_ids", "category")


@query(sql_with("indicators") + "SELECT md5(type || value) AS id, CASE WHEN comment <> '' THEN comment ELSE type || ': ' || value END AS title, CASE WHEN to_ids THEN 'Actionable indicator ' ELSE 'Indicator ' END || value AS description FROM (FROM indicators UNION ALL FROM indicators WHERE event_id % 4 = 1)")
def ioc_to_records(spark, d):
    return P.ioc_to_records(P.parse_ioc_json(_ioc_json(spark, d), "body"), "feed").select("id", "title", "description")


@query(sql_with("indicators") + "SELECT event_id, value, type, CASE WHEN event_id % 2 = 0 THEN 'note' ELSE '' END AS comment FROM indicators")
def parse_ioc_csv(spark, d):
    line = F.concat(F.lit("# head\n\nlonely\n"), "value", F.lit(", "), "type", F.when(F.col("event_id") % 2 == 0, ",note").otherwise(""), F.lit("\r\n"))
    return P.parse_ioc_csv(frame(spark, d, "indicators").select("event_id", line.alias("body")), "body")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'user' WHEN 1 THEN 'k' ELSE 'raw' END AS field, CASE event_id % 3 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN event_type ELSE event_type || ' line' END AS value FROM events")
def parse_feed_by_format(spark, d):
    i = F.col("event_id")
    fmt = F.when(i % 3 == 0, "csv").when(i % 3 == 1, "json").otherwise("txt")
    body = F.when(i % 3 == 0, F.concat(F.lit("user\n"), "user_id", F.lit("\n"))).when(i % 3 == 1, F.concat(F.lit('[{"k": "'), "event_type", F.lit('"}]'))).otherwise(F.concat(F.lit("\n"), "event_type", F.lit(" line\n\n")))
    rows = P.parse_feed_by_format(frame(spark, d, "events").select("event_id", fmt.alias("fmt"), body.alias("body")), "fmt", "body")
    return rows.select("event_id", F.explode("item").alias("field", "value"))


def _bundles(spark, d):
    i = F.col("doc_id")
    first = F.struct(F.concat(F.lit("malware--"), i).alias("id"), F.lit("malware").alias("type"), F.col("source").alias("name"), F.lit("2024-01-01").alias("created"), F.when(i % 2 == 0, F.lit("2024-02-01")).alias("modified"), F.when(i % 3 == 0, F.lit(80)).alias("confidence"), F.array("lang").alias("labels"), F.when(i % 2 == 1, F.array(F.struct(F.concat(F.lit("https://x/"), i).alias("url")))).alias("external_references"))
    return frame(spark, d, "documents").select("doc_id", F.to_json(F.struct(F.lit("bundle").alias("type"), F.array(first).alias("objects"))).alias("body"))


@query("SELECT doc_id, 'malware--' || doc_id AS id, source AS name, CASE WHEN doc_id % 3 = 0 THEN 80 ELSE 50 END AS confidence, lang AS labels FROM documents")
def explode_stix_bundle(spark, d):
    return P.explode_stix_bundle(_bundles(spark, d), "body").select("doc_id", "id", "name", "confidence", F.array_join("labels", ",").alias("labels"))


@query("SELECT 'malware--' || doc_id AS id, CASE WHEN doc_id % 2 = 1 THEN 'https://x/' || doc_id ELSE 'taxii://srv/col/malware--' || doc_id END AS url, source AS title, CASE WHEN doc_id % 2 = 0 THEN '2024-02-01' ELSE '2024-01-01' END AS published_at FROM documents")
def stix_to_records(spark, d):
    return P.stix_to_records(P.explode_stix_bundle(_bundles(spark, d), "body"), "srv", "col").select("id", "url", "title", "published_at")


@query("SELECT md5('10.0.0.' || user_id || ':' || port || 't') AS id, CASE WHEN port IN (443, 8443) THEN 'https://' ELSE 'http://' END || CASE WHEN user_id % 2 = 0 THEN 'h' || user_id ELSE '10.0.0.' || user_id END || CASE WHEN port IN (80, 443) THEN '' ELSE ':' || port END AS url, CASE WHEN event_id % 3 = 0 THEN 'router | nginx' WHEN event_id % 3 = 1 THEN 'SSH-2.0' ELSE 'Event for 10.0.0.' || user_id || ':' || port END AS title, CASE WHEN event_id % 2 = 0 THEN 'iot,CVE-1' ELSE 'iot' END AS tags FROM (SELECT *, CASE event_id % 4 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 8443 ELSE 22 END AS port FROM events)")
def scan_event_to_records(spark, d):
    i, u = F.col("event_id"), F.col("user_id")
    port = F.when(i % 4 == 0, 80).when(i % 4 == 1, 443).when(i % 4 == 2, 8443).otherwise(22)
    rows = frame(spark, d, "events").select(
        F.concat(F.lit("10.0.0."), u).alias("ip"), port.alias("port"), F.when(u % 2 == 0, F.array(F.concat(F.lit("h"), u))).alias("hostnames"), F.when(i % 3 == 0, "nginx").alias("product"), F.when(i % 3 == 0, "router").alias("devicetype"),
        F.when(i % 3 == 1, "SSH-2.0\nmore").otherwise("").alias("banner"), F.when(i % 2 == 0, F.create_map(F.lit("CVE-1"), F.lit("x"))).alias("vulns"), F.array(F.lit("iot")).alias("tags"), F.lit("t").alias("timestamp"))
    return P.scan_event_to_records(rows).select("id", "url", "title", F.array_join("tags", ",").alias("tags"))


@query("SELECT 'https://' || source || '.example.com/feed' AS url, min(lang) AS name FROM documents GROUP BY source")
def seed_feeds(spark, d):
    docs = frame(spark, d, "documents")
    a = docs.select(F.concat(F.lit(" https://"), F.upper("source"), F.lit(".example.com/feed#x")).alias("url"), F.col("lang").alias("name"))
    b = docs.select(F.concat("source", F.lit(".example.com/feed?utm_source=z")).alias("url"))
    return P.seed_feeds(a, b, docs.select(F.lit("no host").alias("url")))


@query("SELECT 'feed.raw' AS topic, 'feed_record:' || doc_id AS key, md5('{\"doc_id\":' || doc_id || ',\"lang\":\"' || lang || '\"}') AS value_md5 FROM documents")
def write_topic(spark, d):
    rows = frame(spark, d, "documents").select("doc_id", "lang")
    return P.write_topic(rows, "feed.raw", F.concat(F.lit("feed_record:"), "doc_id")).select("topic", "key", F.md5("value").alias("value_md5"))


@query(sql_with("indicators") + "SELECT md5('iocs' || '{\"event_id\":' || event_id || '}') AS dlq_id, 'iocs.dlq' AS topic, 604800 AS ttl_seconds FROM indicators WHERE length(value) > 30")
def dead_letter_envelopes(spark, d):
    rows = R.validate_messages(frame(spark, d, "indicators"), [("value", "maxLength", F.length("value") <= 30)]).filter(F.size("errors") > 0)
    return dead_letter(rows, F.lit("iocs"), F.to_json(F.struct("event_id")), F.to_json("errors"), "schema_validation", "consumer", F.lit("now")).select("dlq_id", "topic", "ttl_seconds")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'h' || user_id WHEN event_id % 3 = 1 THEN 'p' || user_id ELSE md5(event_id::VARCHAR) END AS correlation_id FROM events")
def propagate_correlation(spark, d):
    i, u = F.col("event_id"), F.col("user_id")
    headers = F.when(i % 3 == 0, F.create_map(F.lit("correlation_id"), F.concat(F.lit("h"), u))).otherwise(F.create_map(F.lit("correlation_id"), F.lit("")))
    return frame(spark, d, "events").select("event_id", H.propagate_correlation(headers, F.when(i % 3 < 2, F.concat(F.lit("p"), u)), i.cast("string")).alias("correlation_id"))


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE length(source) END AS size, doc_id % 5 <> 0 AS ok, CASE WHEN doc_id % 5 = 0 THEN 'ValueError: bad' END AS error FROM documents")
def map_messages(spark, d):
    def size(row):
        if row["doc_id"] % 5 == 0:
            raise ValueError("bad")
        return str(len(row["source"]))

    return H.map_messages(frame(spark, d, "documents").select("doc_id", "source"), size).select("doc_id", F.col("result").cast("bigint").alias("size"), "ok", "error")


@query("SELECT doc_id, length(source) * 2 AS twice FROM documents")
def map_batches(spark, d):
    return H.map_batches(frame(spark, d, "documents").select("doc_id", "source"), lambda b: b["source"].str.len() * 2, "twice", "long").select("doc_id", "twice")


def shout(texts: pd.Series) -> pd.Series:
    """A stand-in for a model."""
    return texts.str.upper()


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CASE WHEN source = 'src1' THEN 'cached' ELSE upper(source) END END AS answer FROM documents")
def enrich_with(spark, d):
    docs = frame(spark, d, "documents").select("doc_id", "source")
    cache = docs.filter("source = 'src1'").select(F.md5("source").alias("request"), F.lit("cached").alias("answer")).distinct()
    return H.enrich_with(docs, "source", shout, F.col("doc_id") % 2 == 0, cache)[0].select("doc_id", "answer")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'first' WHEN doc_id % 2 = 0 THEN 'second' END AS answered_by FROM documents")
def fallback_chain(spark, d):
    i = F.col("doc_id")
    return H.fallback_chain(frame(spark, d, "documents"), ("first", F.when(i % 4 == 0, F.col("lang"))), ("second", F.when(i % 2 == 0, F.col("source")))).select("doc_id", "answered_by")


def by_language(rows: pd.DataFrame) -> pd.Series:
    return rows["source"].where(rows["lang"].isin(["en", "de"]))


def by_size(rows: pd.DataFrame) -> pd.Series:
    """A provider that only takes rows which the first one left open."""
    if (rows["lang"].isin(["en", "de"]) & rows["source"].notna()).any():
        raise ValueError("answered before")
    return rows["source"].str.upper().where(rows["n_chars"] > 500)


@query("SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN source WHEN n_chars > 500 THEN upper(source) END AS answer, CASE WHEN source IS NULL THEN NULL WHEN lang IN ('en', 'de') THEN 'language' WHEN n_chars > 500 THEN 'size' END AS answered_by FROM documents")
def fallback_calls(spark, d):
    def broken(rows: pd.DataFrame) -> pd.Series:
        raise ConnectionError("no provider")

    docs = frame(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return H.fallback_calls(docs, ("broken", broken), ("language", by_language), ("size", by_size)).select("doc_id", "answer", "answered_by")


@query(sql_with("articles") + "SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\bCVE-[0-9]{4}-[0-9]{4,}\\b')) FROM articles) GROUP BY 1")
def explode_entities(spark, d):
    H.register_entities(spark)
    text = "SELECT doc_id, count(*) AS n FROM {a} a, LATERAL explode_entities(a.text) e WHERE e.kind = 'cve' GROUP BY doc_id"
    return spark.sql(text, a=frame(spark, d, "articles").select("doc_id", "text"))

"""Queries from raw payloads to items, graph tables and dead letters, with their DuckDB SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import ingest as I
from ..sources.stand_ins import frame

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _now():
    return F.lit("2024-02-01T00:00:00+00:00")


def _payloads(spark, d):
    """Documents as payloads: feeds, indicator lists, bundles and bad ones (empty, of no kind, broken) by turns; every tenth comes twice."""
    i = F.col("doc_id")
    entry = F.struct(F.concat(F.lit("g"), i).alias("guid"), F.concat(F.lit("<b>"), "source", F.lit("</b>  &amp; "), "lang").alias("title"), F.concat(F.lit("seen 10.0.0."), i % 250, F.lit(" with CVE-2024-"), i % 90 + 1000).alias("content"), F.concat(F.lit("https://"), "source", F.lit(".example.com/"), i).alias("link"), F.lit("1700000000").alias("published"))
    rss = F.to_json(F.struct(F.struct(F.lit("RSS 2.0").alias("type")).alias("feed_info"), F.array(entry).alias("items")))
    good = F.struct(F.concat(F.lit(" 192.168.7."), i % 250, F.lit(" ")).alias("value"), F.lit("IP-Address").alias("type"), (i % 3 == 0).alias("to_ids"), F.lit("net").alias("category"))
    wrong = F.struct(F.lit("999.1.1.1").alias("value"), F.lit("ip").alias("type"), F.lit(False).alias("to_ids"), F.lit("").alias("category"))
    misp = F.to_json(F.struct(F.array(good, wrong).alias("indicators")))
    thing = F.struct(F.concat(F.lit("malware--"), F.md5(i.cast("string"))).alias("id"), F.lit("malware").alias("type"), F.col("lang").alias("name"), F.lit("2024-01-02T03:04:05Z").alias("created"))
    tool = F.struct(F.concat(F.lit("tool--"), i % 7).alias("id"), F.lit("tool").alias("type"), F.concat(F.lit("tool "), i % 7).alias("name"), F.lit("2024-01-02T03:04:05Z").alias("created"))
    link = F.struct(F.lit("relationship--1").alias("id"), F.lit("relationship").alias("type"), F.concat(F.lit("malware--"), F.md5(i.cast("string"))).alias("source_ref"), F.concat(F.lit("tool--"), i % 7).alias("target_ref"), F.lit("uses").alias("relationship_type"))
    kinds = {x: F.lit(None).cast("string") for x in ("name", "created", "source_ref", "target_ref", "relationship_type")}
    whole = lambda s, have: F.struct(*[(s[c] if c in have else kinds[c]).alias(c) for c in ("id", "type", "name", "created", "source_ref", "target_ref", "relationship_type")])
    stix = F.to_json(F.struct(F.lit("bundle").alias("type"), F.array_compact(F.array(whole(thing, ("id", "type", "name", "created")), F.when(i % 7 < 5, whole(tool, ("id", "type", "name", "created"))), whole(link, ("id", "type", "source_ref", "target_ref", "relationship_type")))).alias("objects")))
    body = F.when(i % 4 == 0, rss).when(i % 4 == 1, misp).when(i % 4 == 2, stix).when(i % 12 == 3, '{"type":"bundle","objects":[]}').when(i % 12 == 7, F.concat(F.lit('{"something":'), i, F.lit("}"))).otherwise(F.concat(F.lit("{broken "), i))
    once = frame(spark, d, "documents").select("doc_id", F.concat(F.lit("https://feeds.example.org/"), i).alias("url"), F.lit("2024-01-01").alias("fetched_at"), body.alias("payload"))
    return once.unionByName(once.filter("doc_id % 10 = 0").withColumn("fetched_at", F.lit("2024-01-02")))


RAW = "WITH raw AS (SELECT *, 1 AS visit FROM documents UNION ALL SELECT *, 2 FROM documents WHERE doc_id % 10 = 0)"


@query(RAW + """ SELECT doc_id, visit, 'g' || doc_id AS id, source || ' & ' || lang AS title, '2023-11-14T22:13:20+00:00' AS published, NULL AS value, NULL AS type, NULL::DOUBLE AS confidence, 'rss_item' AS source_type FROM raw WHERE doc_id % 4 = 0
UNION ALL SELECT doc_id, visit, NULL, NULL, NULL, '192.168.7.' || doc_id % 250, 'ipv4', CASE WHEN doc_id % 3 = 0 THEN 0.9 ELSE 0.6 END, 'misp_indicator' FROM raw WHERE doc_id % 4 = 1
UNION ALL SELECT doc_id, visit, 'malware--' || md5(doc_id::VARCHAR), NULL, '2024-01-02T03:04:05+00:00', NULL, 'malware', 50, 'stix_object' FROM raw WHERE doc_id % 4 = 2
UNION ALL SELECT doc_id, visit, 'tool--' || doc_id % 7, NULL, '2024-01-02T03:04:05+00:00', NULL, 'tool', 50, 'stix_object' FROM raw WHERE doc_id % 4 = 2 AND doc_id % 7 < 5
UNION ALL SELECT doc_id, visit, 'relationship--1', NULL, '2024-02-01T00:00:00+00:00', NULL, 'relationship', 50, 'stix_object' FROM raw WHERE doc_id % 4 = 2""")
def normalize_payload(spark, d):
    raw = _payloads(spark, d).select("doc_id", F.day(F.to_date("fetched_at")).alias("visit"), "payload")
    none = lambda kind="string": F.lit(None).cast(kind)
    rss = I.normalize_payload(raw.filter("doc_id % 4 = 0"), "rss_feed", "payload", _now()).select("doc_id", "visit", "id", "title", "published", none().alias("value"), none().alias("type"), none("double").alias("confidence"), "source_type")
    misp = I.normalize_payload(raw.filter("doc_id % 4 = 1"), "misp_feed", "payload", _now()).select("doc_id", "visit", none().alias("id"), none().alias("title"), none().alias("published"), "value", "type", F.round("confidence", 6).alias("confidence"), "source_type")
    stix = I.normalize_payload(raw.filter("doc_id % 4 = 2"), "stix_bundle", "payload", _now()).select("doc_id", "visit", "id", none().alias("title"), F.col("created").alias("published"), none().alias("value"), "type", F.col("confidence").cast("double").alias("confidence"), "source_type")
    return rss.unionByName(misp).unionByName(stix).unionByName(I.normalize_payload(raw.filter("doc_id % 4 = 3"), "misp_feed", "payload", _now()).select("doc_id", "visit", none().alias("id"), none().alias("title"), none().alias("published"), "value", "type", "confidence", "source_type"))


SEEN = "WITH e AS (SELECT event_id, 'https://s' || user_id % 50 AS url, strftime(ts, '%Y-%m-%d') AS day, user_id, event_id % 3 = 0 AS has_text, event_id % 2 = 0 AS is_ip FROM events), "


@query(SEEN + """i AS (SELECT *, CASE WHEN is_ip THEN 'ipv4' ELSE 'domain' END AS type, CASE WHEN is_ip THEN '10.0.1.' || user_id ELSE 'd' || user_id || '.example.com' END AS value FROM e),
g AS (SELECT DISTINCT '10.0.1.' || user_id AS ip, n_name AS country FROM e JOIN nation ON n_nationkey = user_id % 25)
SELECT 'node' AS part, label AS kind, id FROM (SELECT DISTINCT 'Source' AS label, 'source:' || url AS id FROM e UNION ALL SELECT DISTINCT 'SightingEvent', 'event:' || day FROM e UNION ALL SELECT DISTINCT 'Article', 'article:' || url FROM e WHERE has_text UNION ALL SELECT DISTINCT 'Indicator', 'indicator:' || type || ':' || value FROM i UNION ALL SELECT DISTINCT 'Country', 'country:' || country FROM g)
UNION ALL SELECT 'edge', type, a || ' ' || b FROM (SELECT DISTINCT 'REPORTED_BY' AS type, 'event:' || day AS a, 'source:' || url AS b FROM e UNION ALL SELECT DISTINCT 'ABOUT', 'article:' || url, 'event:' || day FROM e WHERE has_text
  UNION ALL SELECT DISTINCT 'APPEARED_IN', 'indicator:' || type || ':' || value, 'event:' || day FROM i UNION ALL SELECT DISTINCT 'LOCATED_IN', 'indicator:ipv4:' || ip, 'country:' || country FROM g WHERE ip IN (SELECT value FROM i WHERE type = 'ipv4'))""")
def enriched_to_graph(spark, d):
    u, even = F.col("user_id"), F.col("event_id") % 2 == 0
    ip = F.concat(F.lit("10.0.1."), u)
    nations = frame(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("_k"), "n_name")
    events = frame(spark, d, "events").withColumn("_k", u % 25).join(nations, "_k", "left")
    one = F.struct(F.when(even, ip).otherwise(F.concat(F.lit("d"), u, F.lit(".example.com"))).alias("value"), F.when(even, "ipv4").otherwise("domain").alias("type"))
    rows = events.select(F.concat(F.lit("https://s"), u % 50).alias("source_url"), F.date_format("ts", "yyyy-MM-dd").alias("retrieved_at"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("").alias("full_text"), F.array(one).alias("indicators"), F.array(F.struct(ip.alias("ip"), F.col("n_name").alias("country"))).alias("geo_locations"))
    nodes, edges = I.enriched_to_graph(rows)
    return nodes.select(F.lit("node").alias("part"), F.col("label").alias("kind"), "id").unionByName(edges.select(F.lit("edge").alias("part"), F.col("type").alias("kind"), F.concat_ws(" ", "source_id", "target_id").alias("id")))


def _networks(spark, d):
    """Address ranges of countries: 10.0.0.n and 192.168.7.n by the key of a nation."""
    nation = frame(spark, d, "nation")
    low = lambda base: F.lit(base).cast("long") + F.col("n_nationkey") * 4
    return reduce(lambda a, b: a.unionByName(b), [nation.select(low(b).alias("low"), (low(b) + 3).alias("high"), F.col("n_name").alias("country")) for b in (0x0A000000, 0xC0A80700)])


@query(RAW + """, x AS (SELECT *, CASE WHEN doc_id % 4 = 0 THEN 'rss_feed' WHEN doc_id % 4 = 1 THEN 'misp_feed' WHEN doc_id % 4 = 2 OR doc_id % 12 = 3 THEN 'stix_bundle' ELSE 'unknown' END AS kind,
  CASE WHEN doc_id % 4 = 1 THEN 'm' || doc_id % 250 || (doc_id % 3 = 0) WHEN doc_id % 12 = 3 THEN 'empty' ELSE doc_id::VARCHAR END AS body,
  CASE WHEN doc_id % 12 = 3 THEN 'no items' WHEN doc_id % 12 = 7 THEN 'kind unknown' WHEN doc_id % 12 = 11 THEN 'not JSON' END AS why FROM raw),
p AS (SELECT kind, body, any_value(why) AS why, count(*) AS n, arg_min(doc_id, (visit, 'https://feeds.example.org/' || doc_id)) AS i, arg_min(visit, (visit, 'https://feeds.example.org/' || doc_id)) AS visit FROM x GROUP BY 1, 2),
r AS (SELECT p.i, source, lang FROM p JOIN documents ON doc_id = i WHERE kind = 'rss_feed'), m AS (SELECT i, visit, '192.168.7.' || i % 250 AS value FROM p WHERE kind = 'misp_feed'),
s AS (SELECT i, lang, 'malware:' || lang || ':' || left(md5(i::VARCHAR), 8) AS node, 'tool:tool_' || i % 7 || ':' || i % 7 AS tool FROM p JOIN documents ON doc_id = i WHERE kind = 'stix_bundle' AND why IS NULL),
tools AS (SELECT DISTINCT tool FROM s WHERE i % 7 < 5),
ips AS (SELECT DISTINCT 'ip:' || left(md5('10.0.0.' || i % 250), 12) AS id, i % 250 AS n FROM r UNION SELECT 'indicator:ipv4:' || left(md5(value), 8), i % 250 FROM m),
located AS (SELECT id, 'country:' || n_name AS country FROM ips JOIN nation ON n_nationkey = n // 4),
articles AS (SELECT i, 'article:' || source || '.example.com:' || left(md5('https://' || source || '.example.com/' || i), 8) AS id, 'ip:' || left(md5('10.0.0.' || i % 250), 12) AS ip, 'cve:' || left(md5('CVE-2024-' || (i % 90 + 1000)), 12) AS cve FROM r),
events AS (SELECT 'misp_event:' || left(md5('https://feeds.example.org/' || i), 8) || ':2024-01-0' || visit AS event, 'indicator:ipv4:' || left(md5(value), 8) AS id FROM m),
nodes AS (SELECT 'Article' AS label, id FROM articles UNION SELECT 'Indicator', ip FROM articles UNION SELECT 'Vulnerability', cve FROM articles UNION SELECT 'MispEvent', event FROM events UNION SELECT 'Indicator', id FROM events
  UNION SELECT 'Malware', node FROM s UNION SELECT 'Tool', tool FROM tools UNION SELECT 'Country', country FROM located),
edges AS (SELECT 'MENTIONS' AS type, id AS a, ip AS b FROM articles UNION SELECT 'MENTIONS', id, cve FROM articles UNION SELECT 'APPEARED_IN', id, event FROM events UNION SELECT 'USES', node, s.tool FROM s JOIN tools USING (tool) UNION SELECT 'LOCATED_IN', id, country FROM located),
items AS (SELECT 'rss_feed' AS kind, NULL AS error FROM r UNION ALL SELECT 'misp_feed', unnest([NULL, 'invalid indicator']) FROM m UNION ALL SELECT 'stix_bundle', NULL FROM s UNION ALL SELECT 'stix_bundle', NULL FROM s WHERE i % 7 < 5
  UNION ALL SELECT 'stix_bundle', CASE WHEN tool NOT IN (FROM tools) THEN 'end of relation not known' END FROM s),
account AS (SELECT 'payload' AS level, kind, 'in' AS destination, sum(n) AS n FROM p GROUP BY 2 UNION ALL SELECT 'payload', kind, 'duplicate', sum(n - 1) FROM p GROUP BY 2 UNION ALL SELECT 'payload', kind, CASE WHEN why IS NULL THEN 'graph' ELSE 'dead' END, count(*) FROM p GROUP BY 2, 3
  UNION ALL SELECT 'item', kind, 'in', count(*) FROM items GROUP BY 2 UNION ALL SELECT 'item', kind, CASE WHEN error IS NULL THEN 'graph' ELSE 'dead' END, count(*) FROM items GROUP BY 2, 3)
SELECT 'node' AS part, label AS kind, id FROM nodes UNION ALL SELECT 'edge', type, a || ' ' || b FROM edges
UNION ALL SELECT 'dead', why, count(*)::VARCHAR FROM p WHERE why IS NOT NULL GROUP BY 2 UNION ALL SELECT 'dead', error, count(*)::VARCHAR FROM items WHERE error IS NOT NULL GROUP BY 2
UNION ALL SELECT level || ' ' || destination, kind, n::BIGINT::VARCHAR FROM account WHERE n > 0""")
def ingest(spark, d):
    out = I.ingest(_payloads(spark, d).drop("doc_id"), _now(), geo=_networks(spark, d))
    nodes = out.nodes.select(F.lit("node").alias("part"), F.col("label").alias("kind"), "id")
    edges = out.edges.select(F.lit("edge").alias("part"), F.col("type").alias("kind"), F.concat_ws(" ", "source_id", "target_id").alias("id"))
    dead = out.dead.groupBy(F.col("error.message").alias("kind")).agg(F.count(F.lit(1)).cast("string").alias("id")).select(F.lit("dead").alias("part"), "kind", "id")
    account = out.account.select(F.concat_ws(" ", "level", "destination").alias("part"), "kind", F.col("n").cast("string").alias("id"))
    return nodes.unionByName(edges).unionByName(dead).unionByName(account)

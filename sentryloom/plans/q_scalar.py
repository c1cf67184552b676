"""Queries of the column functions, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.stand_ins import frame, sql_with

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


NORM_URL = r"""concat(regexp_extract({u}, '^([A-Za-z]+://)', 1), lower(regexp_extract({u}, '^[A-Za-z]+://([^/?#]*)', 1)), regexp_extract({u}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1),
  CASE WHEN len(list_filter(string_split(regexp_extract({u}, '\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.') AND NOT regexp_matches(p, '^(utm_|(fbclid|gclid)=)'))) > 0
  THEN '?' || array_to_string(list_filter(string_split(regexp_extract({u}, '\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.') AND NOT regexp_matches(p, '^(utm_|(fbclid|gclid)=)')), '&') ELSE '' END)"""


@query("SELECT page_id, " + NORM_URL.replace("{u}", "concat('HTTPS://', upper(substr(url, 9, 4)), substr(url, 13), '#top')").replace("HTTPS", "https") + " AS url FROM pages")
def normalize_url(spark, d):
    u = F.concat(F.lit("https://"), F.upper(F.substring("url", 9, 4)), F.expr("substr(url, 13)"), F.lit("#top"))
    return frame(spark, d, "pages").select("page_id", X.normalize_url(u).alias("url"))


@query("SELECT page_id, regexp_replace(url, '#.*$', '') AS key FROM pages")
def crawl_key(spark, d):
    return frame(spark, d, "pages").select("page_id", X.crawl_key(F.concat("url", F.lit("#frag"))).alias("key"))


@query("SELECT domain, count(*) AS n FROM (SELECT coalesce(nullif(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), ''), 'unknown') AS domain FROM pages) GROUP BY 1")
def url_domain(spark, d):
    return frame(spark, d, "pages").groupBy(X.url_domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT page_id, md5(replace(replace(replace(replace(replace(trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', '''')) AS text_md5 FROM pages""")
def clean_text(spark, d):
    return frame(spark, d, "pages").select("page_id", F.md5(X.clean_text(F.col("html"))).alias("text_md5"))


@query(r"""SELECT page_id, md5(substr(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')), 1, 500000)) AS text_md5 FROM pages""")
def clean_html(spark, d):
    return frame(spark, d, "pages").select("page_id", F.md5(X.clean_html(F.col("html"))).alias("text_md5"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct([lower(trim(x)) FOR x IN [' ' || source, upper(lang), lang, source || ' ']])), ',') AS tags FROM documents")
def normalize_tags(spark, d):
    tags = F.array(F.concat(F.lit(" "), "source"), F.upper("lang"), F.col("lang"), F.concat("source", F.lit(" ")))
    return frame(spark, d, "documents").select("doc_id", F.array_join(X.normalize_tags(tags), ",").alias("tags"))


@query("""SELECT event_id, CASE WHEN event_id % 6 = 5 THEN 'not a time' WHEN event_id % 6 = 3 THEN strftime(ts, '%Y-%m-%dT00:00:00') || '+00:00' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS at FROM events""")
def normalize_timestamp(spark, d):
    ts = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_id") % 6 == 0, F.unix_seconds(ts).cast("string")).when(F.col("event_id") % 6 == 1, F.unix_millis(ts).cast("string")).when(F.col("event_id") % 6 == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    text = text.when(F.col("event_id") % 6 == 3, F.date_format(ts, "yyyy-MM-dd")).when(F.col("event_id") % 6 == 4, F.concat(F.lit("Tue, "), F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).otherwise("not a time")
    return frame(spark, d, "events").select("event_id", X.normalize_timestamp(text, F.lit("now")).alias("at"))


IND = "CASE replace(replace(lower(type), '-', '_'), ' ', '_') WHEN 'ip' THEN 'ipv4' WHEN 'ip_address' THEN 'ipv4' WHEN 'fqdn' THEN 'domain' WHEN 'hostname' THEN 'domain' WHEN 'email_address' THEN 'email' ELSE replace(replace(lower(type), '-', '_'), ' ', '_') END"
VALID = r"""CASE kind WHEN 'ipv4' THEN regexp_matches(value, '^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$')
  WHEN 'domain' THEN regexp_matches(value, '^[a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?(\.[a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*$')
  WHEN 'url' THEN regexp_matches(value, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+') WHEN 'email' THEN regexp_matches(value, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')
  WHEN 'md5' THEN regexp_matches(value, '^[a-fA-F0-9]{32}$') WHEN 'sha256' THEN regexp_matches(value, '^[a-fA-F0-9]{64}$') ELSE length(trim(value)) > 0 END"""


@query(sql_with("indicators") + f", k AS (SELECT *, {IND} AS kind FROM indicators) SELECT kind, {VALID} AS valid, count(*) AS n FROM k GROUP BY 1, 2")
def is_valid_indicator(spark, d):
    k = frame(spark, d, "indicators").withColumn("kind", X.normalize_indicator_type(F.col("type")))
    return k.groupBy("kind", X.is_valid_indicator(F.col("value"), F.col("kind")).alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query(sql_with("indicators") + f"SELECT {IND} AS kind, count(*) AS n FROM indicators GROUP BY 1")
def normalize_indicator_type(spark, d):
    return frame(spark, d, "indicators").groupBy(X.normalize_indicator_type(F.col("type")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(sql_with("indicators") + "SELECT event_id, round(least(1.0, 0.5 + CASE WHEN to_ids THEN 0.3 ELSE 0 END + CASE WHEN category <> '' THEN 0.1 ELSE 0 END + CASE WHEN comment <> '' THEN 0.1 ELSE 0 END)::DOUBLE, 6) AS confidence FROM indicators")
def indicator_confidence(spark, d):
    return frame(spark, d, "indicators").select("event_id", F.round(X.indicator_confidence(F.col("to_ids"), F.col("category"), F.col("comment")), 6).alias("confidence"))


@query(sql_with("indicators") + f", k AS (SELECT *, {IND} AS kind FROM indicators) SELECT event_id, round(least(1.0, 0.5 + CASE WHEN {VALID} THEN 0.3 ELSE 0 END + CASE WHEN context <> '' THEN 0.1 ELSE 0 END + CASE WHEN source_location <> '' THEN 0.05 ELSE 0 END + CASE WHEN confidence > 0.8 THEN 0.15 ELSE 0 END)::DOUBLE, 6) AS quality FROM k")
def indicator_quality(spark, d):
    k = frame(spark, d, "indicators").withColumn("kind", X.normalize_indicator_type(F.col("type")))
    return k.select("event_id", F.round(X.indicator_quality(*[F.col(c) for c in ("value", "kind", "context", "source_location", "confidence")]), 6).alias("quality"))


@query(sql_with("indicators") + """SELECT event_id, md5('{"type": "' || trim(lower(type)) || '", "value": "' || trim(lower(value)) || '"}') AS hash FROM indicators""")
def indicator_hash(spark, d):
    return frame(spark, d, "indicators").select("event_id", X.indicator_hash(F.col("value"), F.col("type")).alias("hash"))


@query(r"""SELECT doc_id, sha256('{"content": "' || replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(9), '\t'), chr(13), '\r') || '", "title": "' || source || '"}') AS hash FROM documents""")
def content_hash(spark, d):
    return frame(spark, d, "documents").select("doc_id", X.content_hash(F.col("source"), F.lit(""), F.lit(None).cast("string"), F.col("text")).alias("hash"))


@query("SELECT doc_id, round((0.2 + 0.3 + 0.1 + CASE WHEN length(text) > 100 THEN 0.2 WHEN length(text) > 50 THEN 0.1 ELSE 0 END)::DOUBLE, 6) AS quality FROM documents")
def content_quality(spark, d):
    none = F.lit(None).cast("string")
    return frame(spark, d, "documents").select("doc_id", F.round(X.content_quality(F.col("source"), F.col("text"), none, none, F.lit(""), F.array("lang")), 6).alias("quality"))


@query(r"SELECT page_id, CASE WHEN contains(t, 'login') OR contains(t, 'sign in') THEN 'login_page' WHEN contains(t, 'error') OR contains(t, 'not found') THEN 'error_page' ELSE 'article' END AS kind FROM (SELECT page_id, lower(CASE page_id % 5 WHEN 0 THEN 'Sign in' WHEN 1 THEN 'Page not found' ELSE regexp_extract(html, '<title>([^<]*)', 1) END) AS t FROM pages)")
def classify_page(spark, d):
    t = F.when(F.col("page_id") % 5 == 0, "Sign in").when(F.col("page_id") % 5 == 1, "Page not found").otherwise(F.regexp_extract("html", "<title>([^<]*)", 1))
    return frame(spark, d, "pages").select("page_id", X.classify_page(t).alias("kind"))


PAY = " OR ".join(f"contains(lower(text), '{w}')" for w in X.PAYWALL)


@query(sql_with("articles") + f"SELECT doc_id, {PAY} AS paywall FROM articles")
def detect_paywall(spark, d):
    return frame(spark, d, "articles").select("doc_id", X.detect_paywall(F.col("text")).alias("paywall"))


VENDOR = "CASE " + " ".join(f"WHEN contains(lower(text), '{v.lower()}') THEN '{v}'" for v in X.VENDORS) + " END"


@query(sql_with("articles") + f"SELECT {VENDOR} AS vendor, count(*) AS n FROM articles GROUP BY 1")
def first_vendor(spark, d):
    return frame(spark, d, "articles").groupBy(X.first_vendor(F.col("text")).alias("vendor")).agg(F.count(F.lit(1)).alias("n"))


BAND = "CASE WHEN s >= 0.8 THEN 'excellent' WHEN s >= 0.6 THEN 'good' WHEN s >= 0.4 THEN 'fair' WHEN s >= 0.2 THEN 'poor' ELSE 'very_poor' END"


@query(f"SELECT {BAND} AS band, count(*) AS n FROM (SELECT least(1.0, value / 500.0) AS s FROM events) GROUP BY 1")
def quality_band(spark, d):
    return frame(spark, d, "events").groupBy(X.quality_band(F.least(F.lit(1.0), F.col("value") / 500.0)).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(sql_with("indicators") + r"""SELECT CASE WHEN v LIKE 'CVE-%' THEN 'cve' WHEN contains(v, '@') AND contains(v, '.') THEN 'email' WHEN regexp_matches(v, '^https?://') THEN 'url' WHEN regexp_matches(v, '^[0-9]+(\.[0-9]+)+$') THEN 'ip' WHEN contains(v, '.') AND NOT contains(v, '/') THEN 'domain'
  WHEN regexp_matches(v, '^[0-9a-fA-F]+$') AND length(v) IN (32, 40, 64, 128) THEN 'hash' WHEN regexp_matches(lower(v), 'apt|group|actor') THEN 'threat_actor' END AS bucket, count(*) AS n FROM (SELECT trim(value) AS v FROM indicators) GROUP BY 1""")
def bucket_ioc(spark, d):
    return frame(spark, d, "indicators").groupBy(X.bucket_ioc(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


CTI = " + ".join(f"contains(lower(text), '{k}')::INT" for k in X.CTI_KEYWORDS)


@query(sql_with("articles") + f"SELECT doc_id, ({CTI}) >= 2 OR regexp_matches(lower(title), '{'|'.join(X.CTI_KEYWORDS)}') AS relevant FROM articles")
def cti_relevant(spark, d):
    return frame(spark, d, "articles").select("doc_id", X.cti_relevant(F.col("title"), F.lit(""), F.col("text")).alias("relevant"))


@query("SELECT doc_id, length(text) > 0 AND (source IS NULL OR length(source) < 20) AS needs FROM documents")
def needs_enrichment(spark, d):
    return frame(spark, d, "documents").select("doc_id", X.needs_enrichment(F.col("source"), F.col("text"), F.col("text")).alias("needs"))


@query("SELECT page_id, page_id % 3 <> 1 AND length(html) BETWEEN 100 AND 10485760 AS fetchable FROM pages")
def fetchable(spark, d):
    kind = F.when(F.col("page_id") % 3 == 0, "text/html; charset=utf-8").when(F.col("page_id") % 3 == 1, "image/png").otherwise("text/plain")
    return frame(spark, d, "pages").select("page_id", X.fetchable(kind, F.length("html")).alias("fetchable"))


@query(sql_with("articles") + "SELECT doc_id, md5(CASE WHEN contains(lower(text), 'password') OR contains(lower(text), 'api_key') THEN '***redacted***' WHEN length(text) > 1000 THEN left(text, 500) || '...[truncated]' ELSE text END) AS text_md5 FROM articles")
def redact(spark, d):
    return frame(spark, d, "articles").select("doc_id", F.md5(X.redact(F.col("text"))).alias("text_md5"))


@query("SELECT doc_id, 'Summarise ' || source || ' (' || lang || '), document ' || doc_id || '.' AS prompt FROM documents")
def render_template(spark, d):
    return frame(spark, d, "documents").select("doc_id", X.render_template("Summarise {source} ({lang}), document {doc_id}.", source=F.col("source"), lang=F.col("lang"), doc_id=F.col("doc_id")).alias("prompt"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 3 = 1 THEN lang ELSE left(text, 20) END AS text FROM documents")
def select_text(spark, d):
    return frame(spark, d, "documents").select("doc_id", X.select_text(F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(""), F.when(F.col("doc_id") % 3 == 1, F.col("lang")), F.left("text", F.lit(20))).alias("text"))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'rss' WHEN 1 THEN 'atom' WHEN 2 THEN 'json' WHEN 3 THEN 'taxii' WHEN 4 THEN 'rss' END AS kind FROM documents")
def detect_feed_kind(spark, d):
    k = F.col("doc_id") % 6
    content = F.when(k == 0, F.concat(F.lit("<?xml version='1.0'?><rss>"), "source")).when(k == 1, F.lit('<feed xmlns="http://www.w3.org/2005/Atom">')).when(k == 2, F.lit('{"version": "1", "items": [1]}')).when(k == 3, F.lit('{"api_roots": ["/a"]}')).otherwise(F.col("lang"))
    return frame(spark, d, "documents").select("doc_id", X.detect_feed_kind(content, F.when(k == 4, "https://x/RSS").otherwise("https://x/")).alias("kind"))


@query("SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'stix_bundle' WHEN 1 THEN 'misp_feed' WHEN 2 THEN 'rss_feed' WHEN 3 THEN 'atom_feed' WHEN 4 THEN 'json_feed' WHEN 5 THEN 'taxii_content' ELSE 'unknown' END AS kind FROM documents")
def detect_payload_kind(spark, d):
    k = F.col("doc_id") % 7
    bodies = ['{"type": "bundle", "objects": [{}]}', '{"Attribute": [1]}', '{"feed_info": {"type": "RSS 2.0"}, "items": [1]}', '{"feed_info": {"type": "atom"}, "items": [1]}', '{"version": "1", "items": [1]}']
    payload = F.get(F.array(*[F.lit(b) for b in bodies]), k.cast("int"))
    return frame(spark, d, "documents").select("doc_id", X.detect_payload_kind(payload, F.when(k == 5, F.concat(F.lit("https://h/taxii2/"), "source")).otherwise("https://h/")).alias("kind"))


@query("SELECT doc_id, round(least(1.0, 0.3 + 0.1 + 0.05 + CASE doc_id % 3 WHEN 0 THEN 0.2 WHEN 1 THEN 0.15 ELSE 0.3 END + CASE WHEN doc_id % 2 = 0 THEN 0.1 ELSE 0 END + CASE WHEN doc_id % 20 > 10 THEN 0.1 WHEN doc_id % 20 > 5 THEN 0.05 ELSE 0 END)::DOUBLE, 6) AS score FROM documents")
def feed_quality(spark, d):
    method = F.get(F.array(F.lit("html_links"), F.lit("common_paths"), F.lit("taxii_discovery")), (F.col("doc_id") % 3).cast("int"))
    content = F.concat(F.when(F.col("doc_id") % 2 == 0, "<pubDate/>").otherwise(""), F.repeat(F.lit("<item>"), (F.col("doc_id") % 20).cast("int")))
    return frame(spark, d, "documents").select("doc_id", F.round(X.feed_quality(F.lit(0.3), F.col("source"), F.lit(""), F.col("lang"), method, content), 6).alias("score"))

"""Threat-intelligence shaped tables derived from the driver's tables.

Each table is one SELECT that Spark SQL and DuckDB both run, so a query and its oracle
start from the same rows.  All grow with the table that they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    # Probes of links: an error event is a failed probe of the user's link.
    "probes": """SELECT event_id, concat('https://h', user_id % 20, '.example.com/u', user_id) AS url, CAST(ts AS TIMESTAMP) AS ts,
      event_type <> 'error' AS success,
      CASE WHEN event_type <> 'error' THEN NULL WHEN event_id % 7 = 0 THEN 'http_404' WHEN event_id % 7 = 1 THEN 'http_410' WHEN event_id % 7 = 2 THEN 'dns_error' WHEN event_id % 7 = 3 THEN 'timeout' ELSE 'http_500' END AS failure_type,
      CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 7 = 0 THEN 404 WHEN event_id % 7 = 1 THEN 410 WHEN event_id % 7 = 4 THEN 403 ELSE 500 END AS status_code,
      value AS response_ms FROM events""",
    # Articles: the documents with a lead sentence of security wording on most of them.
    "articles": """SELECT doc_id, source, lang, concat('https://', source, '.example.com/a/', doc_id) AS url, substr(text, 1, 40) AS title,
      concat(CASE doc_id % 12
        WHEN 0 THEN 'APT28 ran a spear phishing campaign; researchers discovered malware at 10.1.2.3 and evil-c2.badsite.io. '
        WHEN 1 THEN 'Security advisory: CVE-2024-12345 lets attackers use remote code execution; patch now, says Microsoft. '
        WHEN 2 THEN 'Ransomware attack linked to Lazarus; hash: d41d8cd98f00b204e9800998ecf8427e uploaded to https://files.example.org/x?id=1. '
        WHEN 3 THEN 'Our firewall and SIEM release: new feature, update and roadmap. How to get the guide. '
        WHEN 4 THEN 'The endpoint needs authentication; each request and response has a parameter and a rate limit. '
        WHEN 5 THEN 'Subscribe to read this premium content about the market cap, revenue and earnings. '
        WHEN 6 THEN 'Analysis revealed a backdoor; incident response found lateral movement and exfiltration by Fancy Bear. '
        WHEN 7 THEN 'Contact admin@corp.example.net, password: hunter2, api_key=abc. '
        ELSE '' END, coalesce(text, '')) AS text FROM documents""",
    # Indicators of many spellings of type, valid and invalid.
    "indicators": """SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CASE event_id % 9 WHEN 0 THEN 'ip' WHEN 1 THEN 'IP-Address' WHEN 2 THEN 'FQDN' WHEN 3 THEN 'url' WHEN 4 THEN 'Email Address' WHEN 5 THEN 'md5' WHEN 6 THEN 'sha256' WHEN 7 THEN 'Registry Key' ELSE 'hostname' END AS type,
      CASE event_id % 9 WHEN 0 THEN concat('10.', user_id % 300, '.', event_id % 270, '.7') WHEN 1 THEN concat('192.168.', user_id % 256, '.0', user_id % 10) WHEN 2 THEN concat('h', user_id, '.example.com')
        WHEN 3 THEN concat(CASE WHEN event_id % 2 = 0 THEN 'https://' ELSE '' END, 'h', user_id, '.example.com/p') WHEN 4 THEN concat('u', user_id, CASE WHEN event_id % 5 = 0 THEN '#' ELSE '@' END, 'mail.example.com')
        WHEN 5 THEN md5(concat('e', user_id)) WHEN 6 THEN concat(md5(concat('a', user_id)), md5(concat('b', user_id))) WHEN 7 THEN concat('HKLM/Run/', user_id) ELSE concat('-bad', user_id, '.example.com') END AS value,
      CASE WHEN event_id % 3 = 0 THEN 'Network activity' ELSE '' END AS category, CASE WHEN event_id % 4 = 0 THEN 'seen in the wild' ELSE '' END AS comment, event_id % 2 = 0 AS to_ids,
      CASE WHEN event_id % 5 = 0 THEN 'ctx' ELSE '' END AS context, CASE WHEN event_id % 6 = 0 THEN 'char_1-9' ELSE '' END AS source_location, value / 500.0 AS confidence FROM events""",
    # Graph: suppliers, parts and nations as actors, indicators and malware.
    "nodes": """SELECT concat('actor:', s_suppkey) AS id, 'ThreatActor' AS label, s_name AS name FROM supplier
      UNION ALL SELECT concat('indicator:', p_partkey), 'Indicator', p_name FROM part
      UNION ALL SELECT concat('malware:', n_nationkey), 'Malware', n_name FROM nation""",
    "edges": """SELECT DISTINCT concat('indicator:', l_partkey) AS source_id, concat('actor:', l_suppkey) AS target_id, 'INDICATES' AS type FROM lineitem
      UNION ALL SELECT concat('actor:', s_suppkey), concat('malware:', s_nationkey), 'USES' FROM supplier""",
    "mentions": "SELECT DISTINCT l_orderkey % 997 AS article, l_partkey AS indicator FROM lineitem",
    # Tasks of a crawl frontier.
    "frontier": """SELECT event_id AS task_id, concat('https://h', user_id % 20, '.example.com/u', event_id % 400) AS url, round(value / 500.0, 4) AS priority, CAST(ts AS TIMESTAMP) AS created_at,
      CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'completed' WHEN 3 THEN 'failed' ELSE 'pending' END AS status, event_id % 4 AS retry_count, 3 AS max_retries, 60 * (1 + event_id % 30) AS timeout_seconds FROM events""",
    "cache_entries": """SELECT event_id, md5(concat('c', event_id)) AS content_hash, CAST(ts AS TIMESTAMP) AS created_at, event_id % 50 AS access_count, round(value / 500.0, 4) AS threat_score, (user_id % 10) / 10.0 AS content_freshness, (user_id % 4) / 2.0 AS update_frequency, 0.01 AS decay_rate, 1000 * (event_id % 3000) AS content_size FROM events""",
}


def _names(view: str) -> list[str]:
    return [t for t in TABLES if f"FROM {t}" in VIEWS[view]]


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver, or one derived from them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    frames = {}
    for t in _names(name):
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
        frames[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(text, **frames)


def sql_with(*views: str) -> str:
    """The WITH list that gives DuckDB the same derived tables."""
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views) + "\n"

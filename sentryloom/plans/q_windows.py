"""Queries of the window and fold operators, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..sources.stand_ins import frame, sql_with

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


RUN = sql_with("probes") + """, i AS (SELECT *, sum(success::INT) OVER (PARTITION BY url ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM probes),
r AS (SELECT *, sum((NOT success)::INT) OVER (PARTITION BY url, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM i)"""
RECENT = """, f AS (SELECT *, count(*) FILTER (NOT success) OVER w AS failures, count(*) FILTER (failure_type IN ('http_404', 'http_410', 'dns_error')) OVER w AS permanent,
  count(*) FILTER (failure_type IN ('http_404', 'http_410', 'dns_error') OR (NOT success AND status_code IN (403, 404, 410))) OVER w AS permanent_any, count(*) FILTER (success) OVER w AS successes
  FROM (SELECT *, epoch_us(ts) AS us FROM r) WINDOW w AS (PARTITION BY url ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW))"""
HEALTH = """, n AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts, event_id) AS k, CASE WHEN successes > 0 THEN 10 ELSE 0 END - 50 * permanent - 20 * (failures - permanent) AS d FROM f),
h(url, k, x) AS (SELECT url, k, greatest(0, least(100, 100 + d)) FROM n WHERE k = 1 UNION ALL SELECT n.url, n.k, greatest(0, least(100, h.x + n.d)) FROM h JOIN n ON n.url = h.url AND n.k = h.k + 1)"""
RECURSE = lambda s: s.replace("WITH ", "WITH RECURSIVE ", 1)


@query(RUN + " SELECT event_id, run FROM r")
def consecutive_failures(spark, d):
    return W.consecutive_failures(frame(spark, d, "probes")).select("event_id", "run")


@query(RUN + RECENT + " SELECT event_id, failures, permanent, permanent_any FROM f")
def recent_failures(spark, d):
    return W.recent_failures(frame(spark, d, "probes")).select("event_id", "failures", "permanent", "permanent_any")


@query(sql_with("probes") + "SELECT url, string_agg(failure_type, ',' ORDER BY n) AS history FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) AS n FROM probes WHERE NOT success) WHERE n <= 10 GROUP BY 1")
def failure_history(spark, d):
    return W.failure_history(frame(spark, d, "probes")).select("url", F.array_join("history", ",").alias("history"))


@query(RECURSE(RUN + RECENT + HEALTH + " SELECT n.event_id, h.x / 100.0 AS health FROM n JOIN h ON h.url = n.url AND h.k = n.k"))
def health_score(spark, d):
    return W.health_score(frame(spark, d, "probes")).select("event_id", "health")


STATUS = """, o AS (SELECT n.*, CASE WHEN permanent_any >= 1 AND run >= 10 THEN 'dead' WHEN run >= 5 THEN 'quarantined' WHEN run >= 3 THEN 'suspicious' WHEN h.x > 80 AND run = 0 THEN 'healthy' END AS own, h.x AS hx FROM n JOIN h ON h.url = n.url AND h.k = n.k),
s AS (SELECT *, coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY url ORDER BY k ROWS UNBOUNDED PRECEDING), 'healthy') AS status FROM o)"""


@query(RECURSE(RUN + RECENT + HEALTH + STATUS + " SELECT event_id, status, CASE status WHEN 'healthy' THEN 24 WHEN 'suspicious' THEN 12 WHEN 'quarantined' THEN 168 ELSE 720 END AS next_check_hours FROM s"))
def link_status(spark, d):
    return W.link_status(frame(spark, d, "probes")).select("event_id", "status", "next_check_hours")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events),
k(user_id, event_id, t) AS (SELECT user_id, arg_min(event_id, (t, event_id)), min(t) FROM e GROUP BY 1
  UNION ALL SELECT * FROM (SELECT k.user_id, arg_min(e.event_id, (e.t, e.event_id)) AS event_id, min(e.t) AS t FROM k JOIN e ON e.user_id = k.user_id AND e.t >= k.t + 86400000000 GROUP BY k.user_id))
SELECT event_id FROM k""")
def dedupe_ttl(spark, d):
    return W.dedupe_ttl(frame(spark, d, "events"), "user_id", "ts", "event_id").select("event_id")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f(user_id, k, event_id, times, ok) AS (SELECT user_id, k, event_id, [t], true FROM e WHERE k = 1
  UNION ALL SELECT e.user_id, e.k, e.event_id, CASE WHEN len(list_filter(f.times, lambda x: x > e.t - 172800000000)) < 3 THEN list_append(list_filter(f.times, lambda x: x > e.t - 172800000000), e.t) ELSE list_filter(f.times, lambda x: x > e.t - 172800000000) END,
    len(list_filter(f.times, lambda x: x > e.t - 172800000000)) < 3 FROM f JOIN e ON e.user_id = f.user_id AND e.k = f.k + 1)
SELECT event_id, ok AS allowed FROM f""")
def rate_limit_sliding(spark, d):
    return W.rate_limit_sliding(frame(spark, d, "events"), "user_id", "ts", "event_id", 3, 172_800).select("event_id", "allowed")


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) <= 2 AS allowed FROM events")
def rate_limit_fixed(spark, d):
    return W.rate_limit_fixed(frame(spark, d, "events"), "user_id", "ts", "event_id", 2, "day").select("event_id", "allowed")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f(user_id, k, event_id, t, level, ok) AS (SELECT user_id, k, event_id, t, 172800000000::BIGINT, true FROM e WHERE k = 1
  UNION ALL SELECT user_id, k, event_id, t, CASE WHEN lv >= 86400000000 THEN lv - 86400000000 ELSE lv END, lv >= 86400000000 FROM (SELECT e.user_id, e.k, e.event_id, e.t, least(172800000000, f.level - (CASE WHEN f.k = 1 THEN 86400000000 ELSE 0 END) + least(86400000000, e.t - f.t) * 2)::BIGINT AS lv FROM f JOIN e ON e.user_id = f.user_id AND e.k = f.k + 1))
SELECT event_id, ok AS allowed FROM f""")
def token_bucket(spark, d):
    return W.token_bucket(frame(spark, d, "events"), "user_id", "ts", "event_id", 2, 86_400).select("event_id", "allowed")


@query("""SELECT event_id, max(value) OVER w AS best, round((max(value) OVER w - first_value(value) OVER w) / nullif(first_value(value) OVER w, 0) * 100, 4) AS gain_pct FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def best_so_far(spark, d):
    return W.best_so_far(frame(spark, d, "events"), "user_id", "event_id", "value", "event_type").select("event_id", "best", F.round("gain_pct", 4).alias("gain_pct"))


@query("SELECT event_id, count(*) OVER w = 3 AND max(value) OVER w - min(value) OVER w < 40 AS flat FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS 2 PRECEDING)")
def plateau(spark, d):
    return W.plateau(frame(spark, d, "events"), "user_id", "event_id", "value", 3, 40.0).select("event_id", "flat")


@query("SELECT event_id, floor(avg(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) * 1000 + 0.0001)::BIGINT AS mean_thousandths FROM events")
def running_mean(spark, d):
    return W.running_mean(frame(spark, d, "events"), "event_type", "event_id", "value").select("event_id", F.floor(F.col("running_mean") * 1000 + 0.0001).alias("mean_thousandths"))


@query("SELECT event_id, round(greatest(0, least(1, (value - 100) / 300.0))::DOUBLE, 6) AS scaled FROM events")
def radar_normalize(spark, d):
    return W.radar_normalize(frame(spark, d, "events"), F.col("value"), 100.0, 400.0).select("event_id", F.round("scaled", 6).alias("scaled"))

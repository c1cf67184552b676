"""Queries of reports, lookups, sets, frontier and cache tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import aggregates as A
from ..operators import relations as R
from ..operators import similarity as S
from ..operators import windows as W
from ..sources.stand_ins import frame, sql_with
from .q_content import KNOWN, known_pages
from .q_scalar import IND, VALID
from .q_windows import HEALTH, RECENT, RECURSE, RUN, STATUS

QUERIES, ORACLE_SQL = {}, {}
def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r6(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("""WITH p AS (SELECT toxic::VARCHAR AS t, CASE WHEN doc_id % 7 = 0 THEN 'other' ELSE (1 - quality)::VARCHAR END AS p FROM labels),
c AS (SELECT t AS c, count(*) AS support, sum((t = p)::INT) AS hit FROM p GROUP BY 1), s AS (SELECT p AS c, count(*) AS said FROM p GROUP BY 1),
m AS (SELECT c.*, CASE WHEN coalesce(said, 0) > 0 THEN hit / said ELSE 0 END AS pr, hit / support AS re FROM c LEFT JOIN s USING (c)),
f AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f1 FROM m)
SELECT round(sum(pr * support) / sum(support), 6) AS precision, round(sum(re * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1, round(sum(hit) / sum(support), 6) AS accuracy FROM f""")
def classification_report(spark, d):
    rows = frame(spark, d, "labels").withColumn("pred", F.when(F.col("doc_id") % 7 != 0, 1 - F.col("quality")))
    return r6(A.classification_report(rows, "toxic", "pred"), "precision", "recall", "f1", "accuracy")


@query("""WITH r AS (SELECT event_type, value AS x, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY event_type ORDER BY value) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events),
q AS (SELECT *, greatest(1, least(floor(0.95 * (n + 1)), n - 1)) AS low FROM r)
SELECT event_type, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS p50, round(coalesce(max(x) FILTER (k = low) + (0.95 * (max(n) + 1) - max(low)) * (max(x) FILTER (k = low + 1) - max(x) FILTER (k = low)), max(x)), 4) AS p95,
  round(CASE WHEN count(*) < 100 THEN max(x) ELSE quantile_cont(x, 0.99) END, 4) AS p99, round(count(*) / (sum(x) / 1000), 4) AS throughput, avg(ok::INT) AS success_rate FROM q GROUP BY 1""")
def latency_report(spark, d):
    return r6(A.latency_report(frame(spark, d, "events"), "value", F.col("event_type") != "error", ["event_type"]), "mean", "p50", "p95", "p99", "throughput", digits=4)


@query(r"""SELECT role, count(*) AS calls, sum(floor((CASE WHEN length(trim(text)) > 0 THEN len(regexp_split_to_array(trim(text), '[ \t\n\r\f\x0B]+')) ELSE 0 END) * 1.3))::BIGINT AS tokens,
round(sum(floor((CASE WHEN length(trim(text)) > 0 THEN len(regexp_split_to_array(trim(text), '[ \t\n\r\f\x0B]+')) ELSE 0 END) * 1.3)) / 1000 * max(price), 4) AS cost FROM conversations JOIN (VALUES ('user', 0.5), ('assistant', 1.5), ('system', 0.1)) p(role, price) USING (role) GROUP BY 1""")
def usage_cost(spark, d):
    prices = spark.createDataFrame([("user", 0.5), ("assistant", 1.5), ("system", 0.1)], "role string, price double")
    return r6(A.usage_cost(frame(spark, d, "conversations"), prices, "role", "text").drop("cost_per_1k_calls"), "cost", digits=4)


@query("""WITH o AS (SELECT l_orderkey, list_distinct(list(l_partkey) FILTER (l_returnflag = 'R')) AS p, list_distinct(list(l_partkey) FILTER (l_quantity > 25)) AS t FROM lineitem GROUP BY 1),
n AS (SELECT l_orderkey, coalesce(p, []) AS p, coalesce(t, []) AS t FROM o), s AS (SELECT l_orderkey, len(list_intersect(p, t)) AS h, len(p) AS np, len(t) AS nt FROM n),
m AS (SELECT l_orderkey, CASE WHEN np = 0 AND nt = 0 THEN 1 WHEN np = 0 THEN 0 ELSE h / np END AS precision, CASE WHEN np = 0 AND nt = 0 THEN 1 WHEN nt = 0 THEN 0 ELSE h / nt END AS recall FROM s)
SELECT l_orderkey, round(precision::DOUBLE, 6) AS precision, round(recall::DOUBLE, 6) AS recall, round((CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END)::DOUBLE, 6) AS f1 FROM m""")
def set_scores(spark, d):
    some = lambda c: F.collect_set(F.when(c, F.col("l_partkey").cast("string")))
    o = frame(spark, d, "lineitem").groupBy("l_orderkey").agg(some(F.col("l_returnflag") == "R").alias("p"), some(F.col("l_quantity") > 25).alias("t"))
    return r6(A.set_scores(o, "p", "t").select("l_orderkey", "precision", "recall", "f1"), "precision", "recall", "f1")


@query("SELECT event_type, round(CASE WHEN count(*) < 2 THEN 0 ELSE coalesce(corr(value, (user_id % 5)::DOUBLE), 0) END, 6) AS calibration FROM events GROUP BY 1")
def calibration(spark, d):
    return r6(A.calibration(frame(spark, d, "events"), "value", F.col("user_id") % 5, ["event_type"]), "calibration")


METRICS = "SELECT event_type AS metric, avg(value) AS value FROM events GROUP BY 1"
CRITERIA = [("error", "<=", 240.0, 0.0), ("view", ">=", 240.0, 0.0), ("click", "~", 250.0, 10.0), ("signup", "<", 200.0, 0.0), ("absent", ">", 1.0, 0.0)]


@query(f"""WITH m AS ({METRICS}), c(metric, op, target, tolerance) AS (VALUES {', '.join(map(str, CRITERIA))}),
j AS (SELECT c.*, value, coalesce(CASE op WHEN '~' THEN abs(value - target) <= tolerance WHEN '<=' THEN value <= target WHEN '>=' THEN value >= target WHEN '<' THEN value < target ELSE value > target END, false) AS passed, CASE WHEN abs(target) > 0 THEN abs(value - target) / abs(target) ELSE 0 END AS deviation FROM c LEFT JOIN m USING (metric))
SELECT metric, passed, round(deviation::DOUBLE, 6) AS deviation, CASE WHEN passed THEN 'ok' WHEN value IS NULL THEN 'missing' WHEN deviation > 0.1 THEN 'critical' ELSE 'warning' END AS severity FROM j""")
def check_criteria(spark, d):
    metrics = frame(spark, d, "events").groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    criteria = spark.createDataFrame(CRITERIA, "metric string, op string, target double, tolerance double")
    return r6(A.check_criteria(metrics, criteria).select("metric", "passed", "deviation", "severity"), "deviation")


CHANGES = """WITH e AS (SELECT user_id % 40 AS analyzer, event_type AS metric, ts < TIMESTAMP '2024-01-15' AS early, value FROM events), b AS (SELECT analyzer, metric, avg(value) AS before FROM e WHERE early GROUP BY 1, 2), n AS (SELECT analyzer, metric, avg(value) AS now FROM e WHERE NOT early GROUP BY 1, 2),
l(metric, lim) AS (VALUES ('error', 15.0), ('view', -2.0), ('click', 20.0), ('signup', -10.0), ('purchase', -10.0)),
j AS (SELECT analyzer, metric, now - before AS change, CASE WHEN before <> 0 THEN (now - before) / abs(before) * 100 END AS change_pct, lim, now, before FROM n FULL JOIN b USING (analyzer, metric) LEFT JOIN l USING (metric)),
v AS (SELECT *, CASE WHEN now IS NULL OR before IS NULL THEN 'missing' WHEN CASE WHEN lim < 0 THEN change_pct < lim ELSE change_pct > lim END THEN 'regression' WHEN CASE WHEN lim < 0 THEN change_pct > 0 ELSE change_pct < 0 END THEN 'improvement' ELSE 'same' END AS verdict FROM j) """


def _changes(spark, d):
    e = frame(spark, d, "events").select((F.col("user_id") % 40).alias("analyzer"), F.col("event_type").alias("metric"), (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).alias("early"), "value")
    mean = lambda c: e.filter(c).groupBy("analyzer", "metric").agg(F.avg("value").alias("value"))
    limits = spark.createDataFrame([("error", 15.0), ("view", -2.0), ("click", 20.0), ("signup", -10.0), ("purchase", -10.0)], "metric string, limit double")
    return A.compare_baselines(mean(~F.col("early")), mean(F.col("early")), ["analyzer", "metric"], limits)


@query(CHANGES + "SELECT analyzer, metric, round(change, 4) AS change, round(change_pct, 4) AS change_pct, verdict FROM v")
def compare_baselines(spark, d):
    return r6(_changes(spark, d).select("analyzer", "metric", "change", "change_pct", "verdict"), "change", "change_pct", digits=4)


@query(CHANGES + """, a AS (SELECT count(*) FILTER (verdict = 'regression') AS regressions, count(*) FILTER (verdict = 'improvement') AS improvements, count(*) FILTER (verdict = 'regression' AND abs(change_pct) > 10) AS critical, count(*) FILTER (verdict = 'missing') AS missing FROM v)
SELECT *, CASE WHEN critical > 0 THEN 'critical' WHEN regressions > 0 THEN 'regressed' WHEN improvements > 0 THEN 'improved' ELSE 'stable' END AS overall FROM a""")
def assess_change(spark, d):
    return A.assess_change(_changes(spark, d))


LAST = RECURSE(RUN + RECENT + HEALTH + STATUS + ", z AS (SELECT *, hx / 100.0 AS health FROM s QUALIFY row_number() OVER (PARTITION BY url ORDER BY k DESC) = 1)")
STATS = "count(*) AS total, count(*) FILTER (status = 'healthy') AS healthy, count(*) FILTER (status = 'suspicious') AS suspicious, count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'dead') AS dead, count(*) FILTER (health >= 0.8) AS band_good, count(*) FILTER (health >= 0.5 AND health < 0.8) AS band_fair, count(*) FILTER (health >= 0.2 AND health < 0.5) AS band_poor, count(*) FILTER (health < 0.2) AS band_bad, count(*) FILTER (failures > 0) AS failing"
DUE = ", count(*) FILTER (status IN ('quarantined', 'dead') AND TIMESTAMP '2024-02-01' >= ts + CASE status WHEN 'quarantined' THEN INTERVAL 168 HOUR ELSE INTERVAL 720 HOUR END) AS retry_due"


def _health(spark, d):
    return R.dedupe_first(W.link_status(frame(spark, d, "probes")), ["url"], F.desc("ts"), F.desc("event_id"))


@query(LAST + f" SELECT {STATS}{DUE} FROM z")
def link_stats(spark, d):
    return A.link_stats(_health(spark, d), now=now())


@query(LAST + f" SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS domain, {STATS} FROM z GROUP BY 1")
def link_domain_stats(spark, d):
    return A.link_stats(_health(spark, d).withColumn("domain", X.url_domain(F.col("url"))), ["domain"])


@query(LAST + f", lg AS (SELECT *, lag(success) OVER (PARTITION BY url ORDER BY ts, event_id) AS before FROM probes), tr AS (SELECT count(*) FILTER (NOT success) AS failures, count(*) FILTER (success AND NOT coalesce(before, true)) AS recoveries, count(DISTINCT ts::DATE) AS days FROM lg), a AS (SELECT {STATS} FROM z), u AS (SELECT *, CASE WHEN total > 0 THEN (healthy + suspicious) / total ELSE 0 END AS usable FROM a) SELECT total, round(usable::DOUBLE, 6) AS usable, CASE WHEN usable >= 0.9 THEN 'good' WHEN usable >= 0.7 THEN 'degraded' ELSE 'poor' END AS system, CASE WHEN dead > 0 THEN 'remove dead links' WHEN quarantined > 0 THEN 'recheck quarantined links' ELSE 'none' END AS advice, failures, recoveries, failures_net AS net, days FROM u, (SELECT *, recoveries - failures AS failures_net FROM tr)")
def link_report(spark, d):
    return r6(A.link_report(A.link_stats(_health(spark, d)), A.link_health_trend(frame(spark, d, "probes"))).select("total", "usable", "system", "advice", "failures", "recoveries", "net", "days"), "usable")


@query(sql_with("probes") + ", b AS (SELECT *, lag(success) OVER (PARTITION BY url ORDER BY ts, event_id) AS before FROM probes) SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (NOT success) AS failures, count(*) FILTER (success AND NOT coalesce(before, true)) AS recoveries, count(*) FILTER (success AND NOT coalesce(before, true)) - count(*) FILTER (NOT success) AS net FROM b GROUP BY 1")
def link_health_trend(spark, d):
    return A.link_health_trend(frame(spark, d, "probes"))


@query(LAST + " SELECT url, status, (SELECT count(*) FROM z WHERE status = 'healthy' AND contains(url, 'h1')) > 10 AS has_more FROM z WHERE status = 'healthy' AND contains(url, 'h1') ORDER BY url LIMIT 8 OFFSET 2")
def list_links(spark, d):
    return R.list_links(_health(spark, d), "healthy", "h1", 8, 2).select("url", "status", "has_more")


@query(LAST + " SELECT url, CASE WHEN contains(url, 'u1') THEN 'manually_disabled' ELSE status END AS status FROM z")
def bulk_override(spark, d):
    h = _health(spark, d)
    return R.bulk_override(h, h.filter(F.contains("url", F.lit("u1"))), "url", False).select("url", "status")


@query(LAST + " SELECT url, CASE WHEN contains(url, 'u1') THEN 'manually_disabled' WHEN contains(url, 'u2') THEN 'manually_enabled' ELSE status END AS status, CASE WHEN contains(url, 'u1') THEN false WHEN contains(url, 'u2') THEN true WHEN status = 'dead' THEN false WHEN status = 'quarantined' THEN TIMESTAMP '2024-01-31' >= ts + INTERVAL 168 HOUR ELSE true END AS usable FROM z")
def usable_links(spark, d):
    h = _health(spark, d)
    override = F.when(F.contains("url", F.lit("u1")), False).when(F.contains("url", F.lit("u2")), True)
    return W.usable_links(h.withColumn("override", override), F.lit("2024-01-31").cast("timestamp")).select("url", "status", "usable")


@query(sql_with("nodes") + "SELECT label, count(*) AS n, round(least(1, sum(count(*)) OVER () / 10000)::DOUBLE, 6) AS coverage FROM nodes GROUP BY 1")
def graph_stats(spark, d):
    return r6(A.graph_stats(frame(spark, d, "nodes")), "coverage")


@query("SELECT event_type, user_id % 5 AS agent, count(*) AS n, GROUPING(event_type, user_id % 5)::INT AS level FROM events GROUP BY ROLLUP (event_type, user_id % 5)")
def metric_counters(spark, d):
    return A.metric_counters(frame(spark, d, "events").withColumn("agent", F.col("user_id") % 5), ["event_type", "agent"])


@query("SELECT event_type, " + ", ".join(f"count(*) FILTER (value / 100 <= {b}) AS le_{i}" for i, b in enumerate(A.LATENCY_BUCKETS)) + ", round(sum(value / 100), 4) AS sum, count(value) AS count FROM events GROUP BY 1")
def histogram(spark, d):
    return r6(A.histogram(frame(spark, d, "events"), F.col("value") / 100, A.LATENCY_BUCKETS, ["event_type"]), "sum", digits=4)


@query("SELECT event_type, round((floor(value / 500 * 10) / 10)::DOUBLE, 6) AS bucket, count(*) AS n FROM events GROUP BY 1, 2")
def content_mix(spark, d):
    return r6(A.content_mix(frame(spark, d, "events"), "event_type", F.col("value") / 500), "bucket")


@query(sql_with("frontier") + "SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'in_progress') AS in_progress, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, round(count(*) FILTER (status IN ('pending', 'in_progress')) / 100000, 6) AS used, round(avg(priority) FILTER (status = 'pending'), 4) AS pending_priority, round(sum(500000 * timeout_seconds) FILTER (status = 'completed') / count(*) FILTER (status = 'completed') / 1e6, 4) AS mean_seconds, round(count(*) FILTER (status = 'completed') * 6e7 / (max(epoch_us(created_at) + 500000 * timeout_seconds) FILTER (status = 'completed') - min(epoch_us(created_at)) FILTER (status = 'completed')), 6) AS throughput FROM frontier")
def queue_stats(spark, d):
    rows = frame(spark, d, "frontier").withColumn("done_at", F.timestamp_micros(F.unix_micros("created_at") + 500_000 * F.col("timeout_seconds")))
    return r6(r6(A.queue_stats(rows, 100_000, "created_at", "done_at"), "used", "throughput"), "pending_priority", "mean_seconds", digits=4)


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, user_id % 3 AS operation, count(*) AS calls, count(*) FILTER (event_type = 'error') AS errors, ((20 * sum(round(value * 1000)::BIGINT) + count(value)) // (2 * count(value)))::BIGINT / 10000.0::DOUBLE AS mean_latency, count(*) FILTER (event_type = 'error') / count(*) > 0.2 AS breach FROM events GROUP BY 1, 2")
def trace_summary(spark, d):
    return A.trace_summary(frame(spark, d, "events").withColumn("operation", F.col("user_id") % 3), "ts", "operation", F.col("event_type") == "error", "value")


@query("SELECT count(DISTINCT user_id) AS operations, count(*) AS calls, count(*) FILTER (event_type = 'error') AS errors, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_rate, ((20 * sum(round(value * 1000)::BIGINT) + count(value)) // (2 * count(value)))::BIGINT / 10000.0::DOUBLE AS mean_latency, round(sum(round(value / 100 * 1000000)::BIGINT)::DOUBLE / 1000000, 4) AS cost FROM events")
def trace_totals(spark, d):
    return r6(r6(A.trace_totals(frame(spark, d, "events"), "user_id", F.col("event_type") == "error", "value", F.col("value") / 100), "error_rate"), "cost", digits=4)


@query("SELECT user_id, count(*) AS calls, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1 ORDER BY calls DESC, user_id LIMIT 10")
def top_operations(spark, d):
    return A.top_operations(frame(spark, d, "events"), "user_id", F.col("event_type") == "error", 10)


@query("SELECT user_id % 5 AS agent, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def error_summary(spark, d):
    return A.error_summary(frame(spark, d, "events").withColumn("agent", F.col("user_id") % 5), ["agent", "event_type"])


@query(sql_with("indicators") + f", k AS (SELECT *, {IND} AS kind FROM indicators) SELECT kind, round(avg(({VALID})::INT), 6) AS rate FROM k GROUP BY 1")
def validation_rate(spark, d):
    k = frame(spark, d, "indicators").withColumn("kind", X.normalize_indicator_type(F.col("type")))
    return r6(A.validation_rate(k, "kind", X.is_valid_indicator(F.col("value"), F.col("kind"))), "rate")


@query("SELECT source, count(*) AS results, count(DISTINCT lang) AS sources, count(*) FILTER (n_chars > 500) AS extracted FROM documents GROUP BY 1")
def crawl_stats(spark, d):
    return A.crawl_stats(frame(spark, d, "documents"), "source", "lang", F.col("n_chars") > 500)


@query("SELECT count(DISTINCT source) AS queries, count(DISTINCT lang) AS sources, count(*) FILTER (n_chars > 500) AS extracted FROM documents")
def crawl_totals(spark, d):
    return A.crawl_totals(frame(spark, d, "documents"), "source", "lang", F.col("n_chars") > 500)


# Relations ------------------------------------------------------------------


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def dedupe_first(spark, d):
    return R.dedupe_first(frame(spark, d, "events"), ["user_id"], F.col("ts"), F.col("event_id")).select("user_id", "event_id")


@query("SELECT sha256(text) AS hash, min(doc_id) AS first_id, min(n_chars) AS first_seen, max(n_chars) AS last_seen, count(*) AS n FROM documents GROUP BY 1")
def dedupe_content(spark, d):
    return R.dedupe_content(frame(spark, d, "documents"), F.sha2("text", 256), "doc_id", "n_chars")


@query("SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 300)")
def drop_seen(spark, d):
    e = frame(spark, d, "events")
    return R.drop_seen(e, e.filter("event_type = 'purchase' AND value > 300"), "user_id").select("event_id")


CRAWL = "WITH p AS (SELECT page_id, regexp_replace(url, '[?].*', '') AS url FROM pages), s AS (SELECT url FROM p WHERE page_id % 5 = 0), c AS (SELECT url FROM p WHERE page_id % 3 = 0), g AS (SELECT url FROM p WHERE page_id % 7 = 0), r AS (SELECT page_id, url, CASE WHEN url IN (SELECT url FROM s) THEN 'dedupe_hit' WHEN url IN (SELECT url FROM c) THEN 'cache_hit' WHEN url IN (SELECT url FROM g) THEN 'graph_hit' ELSE 'no_checks_failed' END AS reason FROM p) "


def _decisions(spark, d):
    p = frame(spark, d, "pages").select("page_id", F.regexp_replace("url", "[?].*", "").alias("url"))
    known = [p.filter(F.col("page_id") % n == 0).select("url") for n in (5, 3, 7)]
    every = known[0].unionByName(known[1]).unionByName(known[2]).distinct()
    m, k = S.bloom_size(max(every.count(), 1), 0.01)
    asked = S.bloom_contains(p, S.bloom_build(every, "url", m, k), "url", "page_id", m, k)
    return R.should_crawl(asked, *known, maybe="maybe", priority=R.crawl_priority(F.col("url"), F.lit(False), F.lit(0), F.lit(0.0)))


POINTS = "CASE WHEN reason = 'no_checks_failed' THEN 0.5 + CASE WHEN regexp_matches(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), 'security|threat|cert|cisa|mitre|nist') THEN 0.2 ELSE 0 END + CASE WHEN regexp_matches(lower(url), 'vulnerability|cve|advisory|threat|malware|ioc') THEN 0.15 ELSE 0 END ELSE 0.5 END"


@query(CRAWL + f"SELECT page_id, reason, reason = 'no_checks_failed' AS should_crawl, reason = 'dedupe_hit' AS dedupe_hit, reason = 'cache_hit' AS cache_hit, reason = 'graph_hit' AS graph_hit, round(({POINTS})::DOUBLE, 6) AS priority FROM r")
def should_crawl(spark, d):
    return r6(_decisions(spark, d).select("page_id", "reason", "should_crawl", "dedupe_hit", "cache_hit", "graph_hit", "priority"), "priority")


@query(CRAWL + "SELECT count(*) AS total, round(count(*) FILTER (reason = 'no_checks_failed') / greatest(count(*), 1), 6) AS crawl_rate, round(count(*) FILTER (reason = 'cache_hit') / greatest(count(*), 1), 6) AS cache_hit_rate, round(count(*) FILTER (reason = 'dedupe_hit') / greatest(count(*), 1), 6) AS dedupe_rate FROM r")
def crawl_metrics(spark, d):
    return r6(A.crawl_metrics(_decisions(spark, d)), "crawl_rate", "cache_hit_rate", "dedupe_rate")


@query("SELECT page_id FROM pages WHERE url IN (SELECT url FROM pages WHERE page_id % 4 = 0) OR url IN (SELECT replace(url, 'http:', 'https:') FROM pages WHERE page_id % 4 = 0)")
def content_exists(spark, d):
    p = frame(spark, d, "pages")
    nodes = p.filter("page_id % 4 = 0").select("url", F.regexp_replace("url", "^http:", "https:").alias("source_url"))
    return R.content_exists(p.select("page_id", "url"), nodes).select("page_id")


# A page that an event of its own number names is mentioned; the newest are recent intelligence.
CRAWLED = sql_with("mentions") + KNOWN + """, m AS (SELECT url, count(*) AS mention_count FROM pages JOIN (SELECT user_id % 300 AS page_id FROM events WHERE event_type = 'click') USING (page_id) GROUP BY 1),
c AS (SELECT page_id, mention_count, 0.5 + CASE WHEN regexp_matches(lower(host), 'security|threat|cert|cisa|mitre|nist') THEN 0.2 ELSE 0 END + CASE WHEN regexp_matches(lower(url), 'vulnerability|cve|advisory|threat|malware|ioc') THEN 0.15 ELSE 0 END
  + CASE WHEN age <= 3 THEN 0.15 ELSE 0 END + CASE WHEN mention_count > 1 THEN least(0.2, mention_count * 0.1) ELSE 0 END + 0.2 * points AS p FROM g LEFT JOIN m USING (url))"""


@query(CRAWLED + " SELECT page_id, coalesce(mention_count, 0) AS mentions, round(greatest(0, least(1, p))::DOUBLE, 6) AS priority FROM c")
def crawl_priority(spark, d):
    named = frame(spark, d, "events").filter("event_type = 'click'").select((F.col("user_id") % 300).alias("page_id"))
    mentioned = frame(spark, d, "pages").select("page_id", "url").join(named, "page_id").select("url")
    out = R.crawl_priorities(known_pages(spark, d), mentioned, F.col("age_days") <= 3)
    return out.select("page_id", F.col("mention_count").alias("mentions"), F.round("priority", 6).alias("priority"))


@query(sql_with("indicators") + """, i AS (SELECT event_id, string_split(value, '.') AS o FROM indicators WHERE type = 'ip' AND event_id % 270 < 256 AND regexp_matches(value, '^10\\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\\.')),
n AS (SELECT event_id, ((o[1]::BIGINT * 256 + o[2]::BIGINT) * 256 + o[3]::BIGINT) * 256 + o[4]::BIGINT AS ip FROM i)
SELECT event_id, n_name AS country FROM n JOIN nation ON ip BETWEEN 167772160 + n_nationkey * 655360 AND 167772160 + n_nationkey * 655360 + 655359""")
def enrich_geo(spark, d):
    i = frame(spark, d, "indicators").filter(X.is_valid_indicator(F.col("value"), F.lit("ipv4")) & (F.col("type") == "ip"))
    low = F.lit(10 << 24).cast("long") + F.col("n_nationkey").cast("long") * 655_360
    geo = frame(spark, d, "nation").select(low.alias("low"), (low + 655_359).alias("high"), F.col("n_name").alias("country"))
    return R.enrich_geo(i, "value", geo).select("event_id", "country")


@query("SELECT id, string_agg(n_name, '|' ORDER BY pos) AS names FROM (SELECT doc_id AS id, unnest([doc_id % 25, (doc_id * 7) % 60, 3]) AS k, generate_subscripts([1, 2, 3], 1) AS pos FROM documents) JOIN nation ON n_nationkey = k GROUP BY 1")
def enrich_entities(spark, d):
    i = F.col("doc_id")
    rows = frame(spark, d, "documents").select(i.alias("id"), F.array(i % 25, (i * 7) % 60, F.lit(3).cast("long")).alias("ids"))
    dim = frame(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("key"), "n_name")
    return R.enrich_entities(rows, "ids", dim, "key", "details").select("id", F.array_join(F.transform("details", lambda x: x["n_name"]), "|").alias("names"))


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS article, l_partkey AS indicator FROM lineitem), s AS (SELECT x.article AS a, y.article AS b, count(*) AS shared FROM a x JOIN a y ON x.indicator = y.indicator AND x.article <> y.article GROUP BY 1, 2)
SELECT a, b, shared, row_number() OVER (PARTITION BY a ORDER BY shared DESC, b)::INT AS rank FROM s QUALIFY rank <= 3""")
def related_content(spark, d):
    m = frame(spark, d, "lineitem").select(F.col("l_orderkey").alias("article"), F.col("l_partkey").alias("indicator")).distinct()
    return R.related_content(m, "article", "indicator", 3)


@query("""WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT q.vec_id AS query, c.vec_id AS neighbour, list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS cosine FROM q JOIN embeddings c ON c.vec_id <> q.vec_id)
SELECT query, neighbour, round(cosine, 6) AS cosine, row_number() OVER (PARTITION BY query ORDER BY cosine DESC, neighbour)::INT AS rank FROM s QUALIFY rank <= 5""")
def knn(spark, d):
    e = frame(spark, d, "embeddings")
    return r6(R.knn(e.filter("vec_id % 20 = 0"), e, 5), "cosine")


@query(sql_with("nodes", "edges") + "SELECT DISTINCT e.* FROM edges e WHERE source_id NOT IN (SELECT id FROM nodes WHERE id NOT LIKE '%7') OR target_id NOT IN (SELECT id FROM nodes WHERE id NOT LIKE '%7')")
def dangling_edges(spark, d):
    return R.dangling_edges(frame(spark, d, "nodes").filter(~F.col("id").like("%7")), frame(spark, d, "edges"))


PULL = "WITH s AS (SELECT user_id, max(ts) AS watermark FROM events WHERE ts < TIMESTAMP '2024-01-20' AND user_id % 3 <> 0 GROUP BY 1) "


def _pull(spark, d):
    e = frame(spark, d, "events")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    return R.incremental_pull(e, e.filter((F.col("ts") < cut) & (F.col("user_id") % 3 != 0)).groupBy("user_id").agg(F.max("ts").alias("watermark")), "user_id", "ts")


@query(PULL + "SELECT event_id FROM events LEFT JOIN s USING (user_id) WHERE watermark IS NULL OR ts > watermark")
def incremental_pull(spark, d):
    return _pull(spark, d)[0].select("event_id")


@query("SELECT user_id, epoch_us(max(ts)) AS watermark_us FROM events GROUP BY 1")
def incremental_watermarks(spark, d):
    return _pull(spark, d)[1].select("user_id", F.unix_micros(F.col("watermark").cast("timestamp")).alias("watermark_us"))


@query("SELECT kind, lang, count(*) AS n FROM (SELECT 'doc' AS kind, lang FROM documents UNION ALL SELECT 'page', NULL FROM pages) GROUP BY 1, 2")
def union_sources(spark, d):
    both = R.union_sources(frame(spark, d, "documents").select(F.lit("doc").alias("kind"), "lang"), frame(spark, d, "pages").select(F.lit("page").alias("kind")))
    return both.groupBy("kind", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT user_id % 30 AS query, concat(CASE WHEN event_id % 9 = 0 THEN 'ftp' ELSE 'https' END, '://h', event_id % 40) AS url, event_id AS position, event_type AS provider FROM events), f AS (SELECT * FROM r WHERE url LIKE 'https%' QUALIFY row_number() OVER (PARTITION BY query, url ORDER BY position, provider) = 1)
SELECT query, url, provider, row_number() OVER (PARTITION BY query ORDER BY position, provider, url)::INT AS rank FROM f QUALIFY rank <= 10""")
def merge_search_results(spark, d):
    i = F.col("event_id")
    r = frame(spark, d, "events").select((F.col("user_id") % 30).alias("query"), F.concat(F.when(i % 9 == 0, "ftp").otherwise("https"), F.lit("://h"), i % 40).alias("url"), i.alias("position"), F.col("event_type").alias("provider"))
    return R.merge_search_results(r).select("query", "url", "provider", "rank")


@query("SELECT regexp_replace(url, '[?].*', '') AS url FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT DISTINCT url FROM (SELECT regexp_replace(url, '[?].*', '') AS url FROM pages WHERE page_id % 2 = 1) WHERE url NOT IN (SELECT regexp_replace(url, '[?].*', '') FROM pages WHERE page_id % 2 = 0)")
def feed_list_merge(spark, d):
    p = frame(spark, d, "pages").select("page_id", F.regexp_replace("url", "[?].*", "").alias("url"))
    return R.feed_list_merge(p.filter("page_id % 2 = 0").select("url"), p.filter("page_id % 2 = 1").select("url"))


@query("SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def set_overlap(spark, d):
    li = frame(spark, d, "lineitem")
    return li.filter("l_returnflag = 'R'").select("l_partkey").intersect(li.filter("l_quantity > 45").select("l_partkey"))


# Frontier and cache ---------------------------------------------------------

FR = sql_with("frontier")


@query(FR + """, o AS (SELECT * FROM frontier WHERE status IN ('pending', 'in_progress') AND task_id % 2 = 0), n AS (SELECT * FROM frontier WHERE task_id % 2 = 1 AND url NOT IN (SELECT url FROM o) QUALIFY row_number() OVER (PARTITION BY url ORDER BY priority DESC, task_id) = 1)
SELECT task_id, url FROM n QUALIFY row_number() OVER (ORDER BY priority DESC, task_id) <= 100000 - (SELECT count(*) FROM o)""")
def frontier_add(spark, d):
    f = frame(spark, d, "frontier")
    return R.frontier_add(f.filter("task_id % 2 = 0"), f.filter("task_id % 2 = 1"), 100_000).select("task_id", "url")


@query(FR + "SELECT task_id, CASE WHEN task_id IN (SELECT task_id FROM frontier WHERE status = 'pending' ORDER BY priority DESC, task_id DESC LIMIT 50) THEN 'in_progress' ELSE status END AS status FROM frontier")
def frontier_take(spark, d):
    return R.frontier_take(frame(spark, d, "frontier"), 50).select("task_id", "status")


@query(FR + "SELECT task_id, CASE WHEN m AND ok THEN 'completed' WHEN m AND retry_count < 3 THEN 'pending' WHEN m THEN 'failed' ELSE status END AS status, round(CASE WHEN m AND NOT ok AND retry_count < 3 THEN greatest(0, priority - 0.05) ELSE priority END, 4) AS priority, (CASE WHEN m AND NOT ok AND retry_count < 3 THEN retry_count + 1 ELSE retry_count END)::BIGINT AS retry_count FROM (SELECT *, status = 'in_progress' AND task_id % 7 <> 0 AS m, task_id % 2 = 0 AS ok FROM frontier)")
def frontier_complete(spark, d):
    f = frame(spark, d, "frontier")
    results = f.filter("task_id % 7 <> 0").select("task_id", (F.col("task_id") % 2 == 0).alias("success"))
    return r6(R.frontier_complete(f, results).select("task_id", "status", "priority", "retry_count"), "priority", digits=4)


@query(FR + "SELECT task_id, CASE WHEN late AND retry_count < 3 THEN 'pending' WHEN late THEN 'expired' ELSE status END AS status FROM (SELECT *, status = 'in_progress' AND epoch(TIMESTAMP '2024-01-15') - floor(epoch_us(created_at) / 1000000) > timeout_seconds AS late FROM frontier)")
def frontier_expire(spark, d):
    return R.frontier_expire(frame(spark, d, "frontier"), F.lit("2024-01-15").cast("timestamp"), "created_at").select("task_id", "status")


@query(FR + "SELECT task_id FROM frontier WHERE NOT (status IN ('completed', 'failed', 'expired') AND created_at < TIMESTAMP '2024-01-25')")
def frontier_purge(spark, d):
    return R.frontier_purge(frame(spark, d, "frontier"), "created_at", now(), 24 * 7).select("task_id")


@query(FR + "SELECT task_id, task_id % 6 AS agent, row_number() OVER (PARTITION BY task_id % 6 ORDER BY priority DESC, created_at, task_id)::INT AS rank FROM frontier WHERE status = 'pending'")
def task_order(spark, d):
    return R.task_order(frame(spark, d, "frontier").withColumn("agent", F.col("task_id") % 6), "agent").select("task_id", "agent", "rank")


SCORE = sql_with("cache_entries") + """, h AS (SELECT *, epoch_us(TIMESTAMP '2024-02-01') / 3.6e9 - epoch_us(created_at) / 3.6e9 AS hours FROM cache_entries),
s AS (SELECT *, greatest(0, 0.4 * exp(-decay_rate * hours) + 0.3 * CASE WHEN hours > 0 THEN access_count / (1 + ln(1 + hours)) ELSE access_count END + 0.2 * threat_score * content_freshness + 0.1 / (1 + content_size / 1000000)) AS score FROM h),
l AS (SELECT *, CASE WHEN score >= 0.8 THEN 'critical' WHEN score >= 0.6 THEN 'high' WHEN score >= 0.4 THEN 'medium' WHEN score >= 0.2 THEN 'low' ELSE 'archive' END AS level, greatest(3600, least(604800, floor(86400 * (1 + threat_score) * (0.5 + content_freshness) / (1 + update_frequency))))::BIGINT AS ttl FROM s)"""


@query(SCORE + " SELECT event_id, round(score, 4) AS score, level FROM l")
def cache_score(spark, d):
    return r6(R.cache_score(frame(spark, d, "cache_entries"), now()).select("event_id", "score", "level"), "score", digits=4)


@query(SCORE + " SELECT event_id FROM l ORDER BY score DESC, event_id LIMIT 100")
def cache_evict(spark, d):
    return R.cache_evict(R.cache_score(frame(spark, d, "cache_entries"), now()), 100, "event_id").select("event_id")


@query(SCORE + ", v(level) AS (VALUES ('critical'), ('high'), ('medium'), ('low'), ('archive')) SELECT v.level, count(event_id) AS n, round(count(event_id) / 1000000, 6) AS share FROM v LEFT JOIN l USING (level) GROUP BY 1")
def cache_distribution(spark, d):
    levels = spark.createDataFrame([(x,) for x in ("critical", "high", "medium", "low", "archive")], "level string")
    return r6(A.cache_distribution(R.cache_score(frame(spark, d, "cache_entries"), now()), levels, 1_000_000), "share")


@query("SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-18') AS kept, count(*) FILTER (ts < TIMESTAMP '2024-01-18') AS dropped FROM events")
def expire_rows(spark, d):
    return R.expire_rows(frame(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", now(), 14 * 86_400)[1]


@query("""WITH a AS (SELECT DISTINCT l_suppkey AS actor, l_partkey AS indicator FROM lineitem), n AS (SELECT l_partkey AS indicator, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT actor, indicator, coalesce(n, 0) AS n FROM a LEFT JOIN n USING (indicator) WHERE coalesce(n, 0) < 30),
m AS (SELECT actor, list_sort(list(DISTINCT indicator::VARCHAR))[1:3] AS i, count(*) AS indicators, avg(n) AS mean FROM c GROUP BY 1), u AS (SELECT l_suppkey AS actor, list_sort(list(DISTINCT l_orderkey::VARCHAR))[1:5] AS w FROM lineitem WHERE l_quantity > 45 GROUP BY 1)
SELECT actor, indicators, round(mean, 6) AS mean_mentions, round(1 - mean / 30, 6) AS score, (30 - floor(mean))::INT AS missing, array_to_string(list_sort(list_distinct(list_concat([actor::VARCHAR], coalesce(w, []), i))), '|') AS search_terms FROM m LEFT JOIN u USING (actor) ORDER BY mean, actor LIMIT 10""")
def content_gaps(spark, d):
    li = frame(spark, d, "lineitem")
    mentions = li.select(F.col("l_partkey").alias("indicator"))
    uses = li.filter("l_quantity > 45").select(F.col("l_suppkey").alias("actor"), F.col("l_orderkey").alias("malware"))
    out = R.content_gaps(mentions, li.select(F.col("l_suppkey").alias("actor"), F.col("l_partkey").alias("indicator")).distinct(), 30, 10, uses)
    return r6(out.withColumn("search_terms", F.array_join(F.array_sort("search_terms"), "|")), "mean_mentions", "score")


@query("SELECT topic, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN event_type = 'error' THEN 'errors' END, CASE WHEN value > 250 THEN 'slow' END, CASE WHEN user_id % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL)) AS topic FROM events) GROUP BY 1")
def route(spark, d):
    rules = {"errors": F.col("event_type") == "error", "slow": F.col("value") > 250, "even": F.col("user_id") % 2 == 0}
    return R.route(frame(spark, d, "events"), rules).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_id % 5 >= 3 AS dead, CASE WHEN event_id % 5 < 3 THEN event_id % 5 + 1 ELSE event_id % 5 END AS attempt FROM events WHERE event_type = 'error'")
def retry_or_dlq(spark, d):
    again, dead = R.retry_or_dlq(frame(spark, d, "events").withColumn("attempt", F.col("event_id") % 5), F.col("event_type") == "error", "attempt")
    return again.withColumn("dead", F.lit(False)).unionByName(dead.withColumn("dead", F.lit(True))).select("event_id", "dead", "attempt")


@query("SELECT user_id, epoch_us(max(ts)) AS last_us, count(*) AS beats, epoch_us(TIMESTAMP '2024-01-30') - epoch_us(max(ts)) < 86400000000 AS active FROM events GROUP BY 1")
def heartbeat_status(spark, d):
    e = frame(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return R.heartbeat_status(e, "user_id", "ts", F.lit("2024-01-30").cast("timestamp"), 86_400).select("user_id", F.unix_micros("last").alias("last_us"), "beats", "active")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def access_rollup(spark, d):
    e = frame(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query(sql_with("indicators") + "SELECT event_id, array_to_string(list_filter([CASE WHEN NOT length(value) <= 30 THEN 'value:maxLength' END, CASE WHEN NOT type IN ('ip', 'url', 'md5', 'sha256', 'FQDN') THEN 'type:enum' END, CASE WHEN NOT confidence <= 0.9 THEN 'confidence:maximum' END, CASE WHEN NOT regexp_matches(value, '^[A-Za-z0-9]') THEN 'value:pattern' END], lambda x: x IS NOT NULL), ',') AS errors FROM indicators")
def validate_messages(spark, d):
    v, t = F.col("value"), F.col("type")
    rules = [("value", "maxLength", F.length(v) <= 30), ("type", "enum", t.isin("ip", "url", "md5", "sha256", "FQDN")), ("confidence", "maximum", F.col("confidence") <= 0.9), ("value", "pattern", v.rlike("^[A-Za-z0-9]"))]
    out = R.validate_messages(frame(spark, d, "indicators"), rules)
    return out.select("event_id", F.array_join(F.transform("errors", lambda e: F.concat(e["path"], F.lit(":"), e["validator"])), ",").alias("errors"))

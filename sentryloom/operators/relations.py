"""Lookups, set operations, deduplication, frontier and cache tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import Nearest, pairs_by_key, signed, small, written


def dedupe_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key by an order that leaves no ties."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def dedupe_content(df: DataFrame, digest: Column, row_id: str, seen: str) -> DataFrame:
    """One row for each content hash: its first id, when it was first and last seen, and how often."""
    return df.groupBy(digest.alias("hash")).agg(F.min(row_id).alias("first_id"), F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"), F.count(F.lit(1)).alias("n"))


def drop_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return df.join(seen.select(key).distinct(), key, "left_anti")


def content_exists(urls: DataFrame, nodes: DataFrame, url: str = "url") -> DataFrame:
    """URLs that are the ``url`` or ``source_url`` of a node: one existence join on both columns stacked."""
    known = nodes.select(F.explode(F.array("url", "source_url")).alias(url)).distinct()
    return urls.join(known, url, "left_semi")


def should_crawl(urls: DataFrame, seen: DataFrame, cached: DataFrame, graph: DataFrame, key: str = "url", maybe: str | None = None, priority: Column | None = None) -> DataFrame:
    """Adds ``reason`` (dedupe, cache, then graph hit), a flag for each hit, ``should_crawl`` and ``priority``.

    ``maybe`` names a column with the answer of a Bloom filter over all three tables: rows that
    miss it are new and skip the lookups.  ``priority`` holds for URLs to crawl; others, and
    all without it, have 0.5.
    """
    reasons = {"_s": "dedupe_hit", "_c": "cache_hit", "_g": "graph_hit"}
    out = urls if maybe is None else urls.filter(F.col(maybe))
    for name, known in zip(reasons, (seen, cached, graph), strict=True):
        out = out.join(known.select(key).distinct().withColumn(name, F.lit(True)), key, "left")
    if maybe is not None:
        out = out.unionByName(urls.filter(~F.coalesce(F.col(maybe), F.lit(False))), allowMissingColumns=True)
    out = out.withColumn("reason", F.coalesce(*[F.when(F.col(c), r) for c, r in reasons.items()], F.lit("no_checks_failed"))).drop(*reasons)
    crawl = F.col("reason") == "no_checks_failed"
    points = F.lit(0.5) if priority is None else F.when(crawl, priority).otherwise(0.5)
    return out.withColumns({**{r: F.col("reason") == r for r in reasons.values()}, "should_crawl": crawl, "priority": points})


def crawl_priority(url: Column, recent: Column, mentions: Column, graph_priority: Column) -> Column:
    """0.5 with points for the domain, the words of the URL, recency, mentions and the graph, held in [0, 1]."""
    domain = F.lower(F.regexp_extract(url, "^[^:]+://([^/?#]*)", 1)).rlike("security|threat|cert|cisa|mitre|nist")
    words = F.lower(url).rlike("vulnerability|cve|advisory|threat|malware|ioc")
    score = 0.5 + F.when(domain, 0.2).otherwise(0.0) + F.when(words, 0.15).otherwise(0.0) + F.when(recent, 0.15).otherwise(0.0)
    score = score + F.when(mentions > 1, F.least(F.lit(0.2), mentions * 0.1)).otherwise(0.0) + 0.2 * graph_priority
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def crawl_priorities(urls: DataFrame, mentioned: DataFrame, recent: Column) -> DataFrame:
    """``urls`` (with ``url, graph_priority``) with ``mention_count``, the rows of ``mentioned`` (``url``) that name it, and ``priority``."""
    counted = mentioned.groupBy("url").agg(F.count(F.lit(1)).alias("mention_count"))
    out = urls.join(counted, "url", "left").withColumn("mention_count", F.coalesce("mention_count", F.lit(0)))
    return out.withColumn("priority", crawl_priority(F.col("url"), F.coalesce(recent, F.lit(False)), F.col("mention_count"), F.col("graph_priority")))


def enrich_geo(df: DataFrame, ip: str, geo: DataFrame) -> DataFrame:
    """Rows whose IPv4 lies in a network of ``geo`` (``low, high`` as numbers): an equi-join on the first two octets, then the range."""
    number = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("long"), lambda a, x: a * 256 + x.try_cast("long"))
    nets = geo.withColumn("_o", F.explode(F.sequence(F.shiftright("low", 16), F.shiftright("high", 16))))
    rows = df.withColumn("_ip", number).withColumn("_o", F.shiftright("_ip", 16))
    return rows.join(nets, "_o").filter(F.col("_ip").between(F.col("low"), F.col("high"))).drop("_o", "_ip", "low", "high")


def enrich_entities(rows: DataFrame, ids: str, dim: DataFrame, key: str, out: str) -> DataFrame:
    """Adds the details of each id of an array as an array of structs in order of the ids; absent ids are left out, none gives null."""
    each = rows.select("id", F.posexplode(ids).alias("_at", key))
    found = each.join(dim, key).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("_at", F.struct(*dim.columns).alias("d")))).alias("_l"))
    return rows.join(found.select("id", F.transform("_l", lambda x: x["d"]).alias(out)), "id", "left")


#: Mentions of an indicator beyond which its articles no longer meet one by one.
HOT_MENTIONS = 256


def related_content(mentions: DataFrame, article: str, indicator: str, k: int, hot: int = HOT_MENTIONS) -> DataFrame:
    """``a, b, shared, rank``: for each article the k others that share most indicators (ties: the smaller id).

    Articles meet one by one only by indicators with at most ``hot`` mentions.  The others make an
    article's hot set, and articles with one hot set are a class: classes meet, and an article
    gets the k + 1 best (overlap, id) of its class.  That loses none: who shares hot indicators
    alone and is not among them has k others before it, as its class mates and the members of
    closer classes share at least as much.  So no hot list is paired with itself.  Of articles that
    share one indicator alone (``signed`` tells), only the k with the smallest id for each article
    and indicator leave the place where they meet: each other one has k before it.  Repeated
    mentions count once; null articles and indicators have none.
    """
    m = written(signed(mentions, article, indicator))
    often = written(m.groupBy("i").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot).select("i"))
    rare, frequent = m.join(small(often), "i", "left_anti"), m.join(small(often), "i", "left_semi")
    # Dealt by a alone, so that counts and ranks need no further shuffle.
    shared = pairs_by_key(rare, ["i"], Nearest(k, hot)).repartition("a").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    best = lambda df, key, order, n: df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= n)
    some = not often.isEmpty()
    if some:
        sets = frequent.groupBy("x").agg(F.sort_array(F.collect_list("i")).alias("hs"))
        sets = written(sets.withColumn("c", F.sha2(F.to_json("hs"), 256)))
        of = lambda end: sets.select(F.col("x").alias(end), F.col("hs").alias(f"_{end}"))
        both = shared.join(of("a"), "a", "left").join(of("b"), "b", "left")
        shared = both.select("a", "b", (F.col("shared") + F.coalesce(F.size(F.array_intersect("_a", "_b")), F.lit(0))).alias("shared"))
        first = written(best(sets, "c", ["x"], k + 1))
        classes = first.filter("rank = 1").select("c", "hs")
        met = pairs_by_key(classes.select("c", F.explode("hs").alias("i")), ["i"], "c").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        own = classes.select(F.col("c").alias("a"), F.col("c").alias("b"), F.size("hs").cast("long").alias("n"))
        met = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")).unionByName(own)
        nearest = best(met.join(first.select(F.col("c").alias("b"), "x"), "b").select("a", "x", "n"), "a", [F.desc("n"), F.col("x")], k + 1)
        nearest = small(written(nearest.select(F.col("a").alias("c"), F.col("x").alias("b"), F.col("n").alias("shared"))))
        by_class = sets.select(F.col("x").alias("a"), "c").join(nearest, "c").filter("a <> b").select("a", "b", "shared")
        shared = shared.unionByName(by_class).groupBy("a", "b").agg(F.max("shared").alias("shared"))
    return best(shared, "a", [F.desc("shared"), F.col("b")], k)


def knn(queries: DataFrame, corpus: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", block_rows: int = 2048) -> DataFrame:
    """The k nearest corpus rows of each row of a stated query set by cosine (ties: the smaller key), exactly.

    Both sides are packed into matrices of about ``block_rows`` rows; each pair of blocks is
    one matrix product that gives k rows a query, and a window keeps the best k of all.
    No side is held whole anywhere.
    """
    import numpy as np
    import pandas as pd

    def packed(df: DataFrame, name: str) -> DataFrame:
        blocks = max(1, -(-df.count() // block_rows))

        def pack(rows):
            m = np.array(rows[vector].tolist(), np.float64).reshape(len(rows), -1)
            m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
            return pd.DataFrame({f"{name}_ids": [rows[key].to_numpy(np.int64).tobytes()], f"{name}_m": [m.tobytes()]})

        rows = df.select(key, vector).withColumn("_b", F.pmod(F.xxhash64(key), F.lit(blocks)))
        return rows.groupBy("_b").applyInPandas(pack, f"{name}_ids binary, {name}_m binary")

    def best(batches):
        for batch in batches:
            for qi, qm, ci, cm in zip(batch["q_ids"], batch["q_m"], batch["c_ids"], batch["c_m"], strict=True):
                q, c = np.frombuffer(qi, np.int64), np.frombuffer(ci, np.int64)
                order = np.argsort(c, kind="stable")
                sims = np.frombuffer(qm).reshape(len(q), -1) @ np.frombuffer(cm).reshape(len(c), -1)[order].T
                c = c[order]
                sims[q[:, None] == c[None, :]] = -2.0
                top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                yield pd.DataFrame({"query": np.repeat(q, top.shape[1]), "neighbour": c[top].ravel(), "cosine": np.take_along_axis(sims, top, 1).ravel()})

    near = packed(queries, "q").crossJoin(packed(corpus, "c")).mapInPandas(best, "query long, neighbour long, cosine double").filter("cosine > -2")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), "neighbour"))
    return near.withColumn("rank", nth).filter(F.col("rank") <= k)


def dangling_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges of which an end is no node."""
    ids = nodes.select("id")
    miss = lambda end: edges.join(ids.withColumnRenamed("id", end), end, "left_anti").select(*edges.columns)
    return miss("source_id").unionByName(miss("target_id")).distinct()


def incremental_pull(df: DataFrame, state: DataFrame, key: str, ts: str) -> tuple[DataFrame, DataFrame]:
    """Rows newer than their key's watermark, and the watermarks after them."""
    fresh = df.join(state, key, "left").filter(F.col("watermark").isNull() | (F.col(ts) > F.col("watermark"))).drop("watermark")
    after = fresh.groupBy(key).agg(F.max(ts).alias("_new")).join(state, key, "full_outer").select(key, F.greatest("_new", "watermark").alias("watermark"))
    return fresh, after


def union_sources(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_search_results(results: DataFrame, per_query: int = 10) -> DataFrame:
    """http(s) results of all providers: of each query and URL the first, at most so many a query, ranked."""
    ok = results.filter(F.col("url").rlike("^https?://"))
    first = dedupe_first(ok, ["query", "url"], F.col("position"), F.col("provider"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("position", "provider", "url"))
    return first.withColumn("rank", nth).filter(F.col("rank") <= per_query)


def feed_list_merge(existing: DataFrame, found: DataFrame, key: str = "url") -> DataFrame:
    """Existing rows and those found that are not listed yet, once each."""
    return existing.unionByName(found.join(existing, key, "left_anti").select(*existing.columns).distinct())


def bulk_override(health: DataFrame, urls: DataFrame, key: str, flag: bool) -> DataFrame:
    """Sets the manual override of the given keys; status follows it."""
    out = health.join(urls.select(key).distinct().withColumn("_o", F.lit(flag)), key, "left")
    return out.withColumn("status", F.when(F.col("_o"), "manually_enabled").when(~F.col("_o"), "manually_disabled").otherwise(F.col("status"))).withColumn("override", F.col("_o")).drop("_o")


def list_links(df: DataFrame, status: str, search: str, limit: int, offset: int, key: str = "url") -> DataFrame:
    """One page of the links with a status whose key contains a text, with ``has_more``."""
    hits = df.filter((F.col("status") == status) & F.contains(F.col(key), F.lit(search)))
    page = hits.orderBy(key).offset(offset).limit(limit + 1)
    nth = F.row_number().over(Window.orderBy(key))
    return page.withColumn("_n", nth).withColumn("has_more", F.max("_n").over(Window.partitionBy()) > limit).filter(F.col("_n") <= limit).drop("_n")


# Frontier tables ------------------------------------------------------------


def frontier_add(frontier: DataFrame, new: DataFrame, capacity: int) -> DataFrame:
    """New tasks that enter: their URL is not open yet, and there is room for them, best first."""
    open_tasks = frontier.filter(F.col("status").isin("pending", "in_progress"))
    used = open_tasks.agg(F.count(F.lit(1)).alias("_used"))
    fresh = dedupe_first(new.join(open_tasks.select("url").distinct(), "url", "left_anti"), ["url"], F.desc("priority"), F.col("task_id"))
    ranked = fresh.orderBy(F.desc("priority"), "task_id").limit(capacity).withColumn("_n", F.row_number().over(Window.orderBy(F.desc("priority"), "task_id")))
    return ranked.join(F.broadcast(used)).filter(F.col("_n") <= capacity - F.col("_used")).drop("_n", "_used")


def frontier_take(frontier: DataFrame, n: int) -> DataFrame:
    """The frontier after its n best pending tasks (ties: the larger id) went in progress."""
    taken = frontier.filter("status = 'pending'").orderBy(F.desc("priority"), F.desc("task_id")).limit(n).select("task_id").withColumn("_t", F.lit(True))
    return frontier.join(small(taken), "task_id", "left").withColumn("status", F.when(F.col("_t"), "in_progress").otherwise(F.col("status"))).drop("_t")


def frontier_complete(frontier: DataFrame, results: DataFrame) -> DataFrame:
    """Results applied to tasks in progress: done, back to pending with less priority while retries are left, or failed."""
    out = frontier.join(results, "task_id", "left")
    mine = (F.col("status") == "in_progress") & F.col("success").isNotNull()
    retry = F.col("retry_count") < F.col("max_retries")
    back = mine & ~F.col("success") & retry
    status = F.when(mine & F.col("success"), "completed").when(back, "pending").when(mine, "failed").otherwise(F.col("status"))
    return out.withColumns({"priority": F.when(back, F.greatest(F.lit(0.0), F.col("priority") - 0.05)).otherwise(F.col("priority")), "retry_count": F.when(back, F.col("retry_count") + 1).otherwise(F.col("retry_count")), "status": status}).drop("success")


def frontier_expire(frontier: DataFrame, now: Column, started: str) -> DataFrame:
    """Tasks in progress past their timeout go back to pending (retry + 1, priority - 0.1) or expire."""
    late = (F.col("status") == "in_progress") & (F.unix_seconds(now) - F.unix_seconds(F.col(started)) > F.col("timeout_seconds"))
    back = late & (F.col("retry_count") < F.col("max_retries"))
    return frontier.withColumns({"priority": F.when(back, F.greatest(F.lit(0.0), F.col("priority") - 0.1)).otherwise(F.col("priority")), "retry_count": F.when(back, F.col("retry_count") + 1).otherwise(F.col("retry_count")), "status": F.when(back, "pending").when(late, "expired").otherwise(F.col("status"))})


def expire_rows(df: DataFrame, ts: str, now: Column, seconds: int) -> tuple[DataFrame, DataFrame]:
    """What a retention time keeps, and counts of kept and dropped rows for a dry run."""
    keep = F.unix_micros(F.col(ts)) >= F.unix_micros(now) - seconds * 1_000_000
    return df.filter(keep), df.agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))


def frontier_purge(frontier: DataFrame, ts: str, now: Column, hours: int) -> DataFrame:
    """The frontier without finished tasks older than so many hours."""
    old = F.col("status").isin("completed", "failed", "expired") & (F.unix_micros(F.col(ts)) < F.unix_micros(now) - hours * 3_600_000_000)
    return frontier.filter(~old)


def task_order(tasks: DataFrame, agent: str) -> DataFrame:
    """Pending tasks of each agent, best priority first, then by arrival."""
    return tasks.filter("status = 'pending'").withColumn("rank", F.row_number().over(Window.partitionBy(agent).orderBy(F.desc("priority"), "created_at", "task_id")))


def cache_score(entries: DataFrame, now: Column) -> DataFrame:
    """Adds ``score``, ``level`` and ``ttl`` of cache entries from age, use, threat, freshness and size."""
    hours = (F.unix_micros(now) - F.unix_micros("created_at")) / 3.6e9
    use = F.when(hours > 0, F.col("access_count") / (1 + F.log(1 + hours))).otherwise(F.col("access_count"))
    score = 0.4 * F.exp(-F.col("decay_rate") * hours) + 0.3 * use + 0.2 * F.col("threat_score") * F.col("content_freshness") + 0.1 / (1 + F.col("content_size") / 1_000_000)
    s = F.col("score")
    level = F.when(s >= 0.8, "critical").when(s >= 0.6, "high").when(s >= 0.4, "medium").when(s >= 0.2, "low").otherwise("archive")
    ttl = F.floor(86_400 * (1 + F.col("threat_score")) * (0.5 + F.col("content_freshness")) / (1 + F.col("update_frequency")))
    return entries.withColumn("score", F.greatest(F.lit(0.0), score)).withColumn("level", level).withColumn("ttl", F.greatest(F.lit(3600), F.least(F.lit(7 * 86_400), ttl)))


def cache_evict(scored: DataFrame, most: int, key: str) -> DataFrame:
    """The entries that stay within a cap, best score first (a top-n report of the cap's size)."""
    return scored.orderBy(F.desc("score"), key).limit(most)


def content_gaps(mentions: DataFrame, actors: DataFrame, threshold: int, k: int, uses: DataFrame | None = None) -> DataFrame:
    """Actors whose indicators are mentioned least: indicators below the threshold, their mean mentions, and score 1 - mean / threshold; the first k.

    ``missing`` is the threshold less the whole part of the mean.  ``search_terms`` are the
    actor, its first 5 ``malware`` of ``uses`` (rows ``actor, malware``) and 3 indicators by
    name, each once.  Only the k actors gather terms.
    """
    counted = actors.join(mentions.groupBy("indicator").agg(F.count(F.lit(1)).alias("n")), "indicator", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    thin = counted.filter(F.col("n") < threshold)
    means = thin.groupBy("actor").agg(F.count(F.lit(1)).alias("indicators"), F.avg("n").alias("mean_mentions"))
    gaps = means.orderBy("mean_mentions", "actor").limit(k).withColumns({"score": 1 - F.col("mean_mentions") / threshold, "missing": threshold - F.floor("mean_mentions").cast("int")})

    def terms(rows: DataFrame, name: str, most: int) -> DataFrame:
        rows = rows.select("actor", F.col(name).cast("string").alias("_t")).filter("_t IS NOT NULL").join(F.broadcast(gaps.select("actor")), "actor", "left_semi").distinct()
        first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("actor").orderBy("_t"))).filter(F.col("_r") <= most)
        return first.groupBy("actor").agg(F.array_sort(F.collect_list("_t")).alias(f"_{name}"))

    none = F.array().cast("array<string>")
    out = gaps.join(terms(thin, "indicator", 3), "actor", "left")
    out = out.withColumn("_malware", none) if uses is None else out.join(terms(uses, "malware", 5), "actor", "left")
    words = F.concat(F.array(F.col("actor").cast("string")), F.coalesce("_malware", none), F.coalesce("_indicator", none))
    return out.withColumn("search_terms", F.array_distinct(words)).drop("_malware", "_indicator")


def route(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row for each topic whose condition holds."""
    topics = F.array_compact(F.array(*[F.when(c, F.lit(t)) for t, c in rules.items()]))
    return df.withColumn("topic", F.explode(topics))


def retry_or_dlq(df: DataFrame, failed: Column, attempts: str, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Failed rows with attempts left (one more counted), and those for the dead-letter topic."""
    bad = df.filter(failed)
    return bad.filter(F.col(attempts) < most).withColumn(attempts, F.col(attempts) + 1), bad.filter(F.col(attempts) >= most)


def heartbeat_status(beats: DataFrame, agent: str, ts: str, now: Column, timeout: int = 300) -> DataFrame:
    last = beats.groupBy(agent).agg(F.max(ts).alias("last"), F.count(F.lit(1)).alias("beats"))
    return last.withColumn("active", F.unix_micros(now) - F.unix_micros("last") < timeout * 1_000_000)


# Rules on messages ----------------------------------------------------------


def validate_messages(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Adds ``errors``: for each rule ``(path, validator, holds)`` that does not hold, what it is and the value (100 characters at most)."""
    marks = [F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(path).alias("path"), F.lit(kind).alias("validator"), F.left(F.col(path).cast("string"), F.lit(100)).alias("invalid_value"))) for path, kind, ok in rules]
    return df.withColumn("errors", F.array_compact(F.array(*marks)))

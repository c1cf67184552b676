"""Streams over files give what the batch operators give."""

from __future__ import annotations

import glob
import json
import os
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from sentryloom.operators import windows as W
from sentryloom.operators.ingest import ingest
from sentryloom.operators.relations import dangling_edges, dedupe_first
from sentryloom.plans.q_ingest import _networks, _payloads
from sentryloom.sources.parsers import export_link_health, import_link_health, read_topic
from sentryloom.sources.stand_ins import frame
from sentryloom.streaming import graph_store as G
from sentryloom.streaming import streams as S

SF = "/root/testdata/sf0.001"


def landed(df, parts=3, ts="event_id"):
    path = tempfile.mkdtemp(prefix="stream-")
    df.repartitionByRange(parts, ts).write.mode("overwrite").parquet(path)
    return path


def collected(spark, stream, mode):
    name = f"t{abs(hash(tempfile.mktemp()))}"
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


@pytest.mark.parametrize("backwards", [False, True])
def test_link_health_stream_matches_batch_in_any_order(spark, backwards):
    """The last state of each link is the batch result, whether the files come in time order or against it."""
    probes = frame(spark, SF, "probes").withColumn("ts", F.col("ts").cast("timestamp"))
    path = landed(probes, ts="ts")
    parts = sorted(glob.glob(f"{path}/part-*"))
    for at, part in enumerate(reversed(parts) if backwards else parts):
        os.utime(part, (1_700_000_000 + at * 60,) * 2)
    stream = spark.readStream.schema(probes.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = {}
    table = collected(spark, S.link_health_stream(stream, "60 days").withColumn("at", F.current_timestamp()), "update")
    for r in table.orderBy("at").collect():
        out[r.url] = (r.run, r.health, r.status)
    batch = dedupe_first(W.link_status(probes), ["url"], F.desc("ts"), F.desc("event_id")).collect()
    assert len(parts) > 1 and out == {r.url: (r.run, r.health, r.status) for r in batch}


def test_link_health_stream_settles_behind_the_watermark(spark):
    """In time order, a short lateness gives the same last state: what is older is settled and leaves the buffer."""
    probes = frame(spark, SF, "probes").withColumn("ts", F.col("ts").cast("timestamp"))
    path = landed(probes, ts="ts")
    for at, part in enumerate(sorted(glob.glob(f"{path}/part-*"))):
        os.utime(part, (1_700_000_000 + at * 60,) * 2)
    stream = spark.readStream.schema(probes.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = {}
    for r in collected(spark, S.link_health_stream(stream, "1 hour").withColumn("at", F.current_timestamp()), "update").orderBy("at").collect():
        out[r.url] = (r.run, r.health, r.status)
    assert out == {r.url: (r.run, r.health, r.status) for r in dedupe_first(W.link_status(probes), ["url"], F.desc("ts"), F.desc("event_id")).collect()}


def test_validate_stream_splits_and_counts(spark):
    rows = frame(spark, SF, "indicators").select("event_id", "value", "confidence")
    path, good, bad, checkpoint = landed(rows), *(tempfile.mkdtemp(prefix=p) for p in ("good-", "bad-", "check-"))
    stream = spark.readStream.schema(rows.schema).parquet(path)
    S.validate_stream(stream, [("value", "maxLength", F.length("value") <= 30)], "iocs", good, bad, checkpoint).awaitTermination(120)
    dead = spark.read.parquet(bad)
    assert spark.read.parquet(good).count() + dead.count() == rows.count() and dead.count() == rows.filter("length(value) > 30").count()
    assert dead.select("topic").distinct().collect()[0][0] == "iocs.dlq"


def in_files(spark, rows, schema, sizes):
    """A folder of files of so many rows each, read one file a batch in that order, and its stream."""
    path, at = tempfile.mkdtemp(prefix="stream-"), 0
    for k, n in enumerate(sizes):
        spark.createDataFrame(rows[at : at + n], schema).coalesce(1).write.mode("append").parquet(path)
        at += n
        for new in glob.glob(f"{path}/part-*"):
            if os.path.getmtime(new) > 1_700_100_000:
                os.utime(new, (1_700_000_000 + k * 60,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("shuffled", [False, True])
def test_stream_dedupe_is_the_batch_operator_for_any_split(spark, shuffled):
    """Rows days apart in one batch, ties, null keys, ids over 2^53; out of order within the lateness."""
    rng = random.Random(4)
    begin = datetime(2024, 1, 1)
    schema = "k string, i long, ts timestamp, note long"
    rows = [(rng.choice(["a", "b", None]), (1 << 60) + i, begin + timedelta(hours=2 * i, microseconds=7), None if i % 3 else (1 << 55) + 1) for i in range(150)]
    rows += [("c", 1000 + d, begin + timedelta(days=3 * d), None) for d in range(3)] + [("a", 7, rows[10][2], None)]
    want = sorted((r.k or "", r.i, str(r.ts), r.note) for r in W.dedupe_ttl(spark.createDataFrame(rows, schema), "k", "ts", "i").collect())
    rows.sort(key=lambda r: r[2])
    if shuffled:
        for at in range(0, len(rows), 20):
            rows[at : at + 20] = rng.sample(rows[at : at + 20], len(rows[at : at + 20]))
    end = [("end", 0, begin + timedelta(days=100), None), ("end", 1, begin + timedelta(days=200), None)]
    for sizes in ([len(rows), 1, 1], [1, 60, 7, len(rows) - 68, 1, 1]):
        out = collected(spark, S.stream_dedupe(in_files(spark, rows + end, schema, sizes), ["k"], "ts", "i", late="3 days"), "append")
        got = sorted((r.k or "", r.i, str(r.ts), r.note) for r in out.filter("k IS NULL OR k <> 'end'").collect())
        assert got == want and sum(r[0] == "c" for r in got) == 3


def test_counters(spark):
    rows = frame(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(landed(rows, 1))
    got = collected(spark, S.stream_first(stream(), ["user_id"], "ts", "365 days"), "append")
    assert got.count() == rows.select("user_id").distinct().count()
    counts = collected(spark, S.stream_counters(stream(), "ts", ["event_type"]), "complete")
    assert counts.agg(F.sum("n")).first()[0] == rows.count()


@pytest.mark.parametrize("sizes", [(120,), (1, 50, 69), (40, 40, 40)])
def test_link_health_with_null_codes_ties_and_any_order(spark, sizes):
    rng = random.Random(sum(sizes) + len(sizes))
    begin = datetime(2024, 1, 1)
    schema = "url string, ts timestamp, event_id long, success boolean, failure_type string, status_code int"
    rows = [(rng.choice(["https://a", "https://b"]), begin + timedelta(hours=rng.randint(0, 90)), i, rng.choice([True, False, False, None]), rng.choice(["dns_error", "timeout", None]), rng.choice([None, 403, 500])) for i in range(120)]
    out = {}
    table = collected(spark, S.link_health_stream(in_files(spark, rows, schema, sizes), "60 days").withColumn("at", F.current_timestamp()), "update")
    for r in table.orderBy("at").collect():
        out[r.url] = (r.run, r.health, r.status)
    batch = dedupe_first(W.link_status(spark.createDataFrame(rows, schema)), ["url"], F.desc("ts"), F.desc("event_id")).collect()
    assert out == {r.url: (r.run, r.health, r.status) for r in batch} and len(out) == 2


def test_links_fall_due_and_are_forgotten(spark):
    begin = datetime(2024, 1, 1)
    schema = "url string, ts timestamp, event_id long, success boolean, failure_type string, status_code int"
    probe = lambda url, hours, ok: (url, begin + timedelta(hours=hours), hours, ok, None if ok else "dns_error", None)
    rows = [probe("https://a", h, False) for h in range(6)] + [probe("https://b", 30 * 24, True), probe("https://b", 200 * 24, True), probe("https://b", 400 * 24, True)]
    stream = S.link_health_stream(in_files(spark, rows, schema, (6, 1, 1, 1)), "1 hour", most_waiting=4).withColumn("at", F.current_timestamp())
    out = [(r.url, r.run, r.status, r.due) for r in collected(spark, stream, "update").orderBy("at").collect()]
    mine = [r for r in out if r[0] == "https://a"]
    assert mine[0] == ("https://a", 6, "quarantined", False) and ("https://a", 6, "quarantined", True) in mine and len(mine) == 2


def test_upsert_keeps_the_latest(spark):
    rows = frame(spark, SF, "events").select((F.col("user_id") % 5).alias("id"), F.col("event_id").alias("version"), "event_type", "event_id")
    path, target, checkpoint = landed(rows), tempfile.mkdtemp(prefix="graph-"), tempfile.mkdtemp(prefix="check-")
    S.upsert_graph(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path), target, checkpoint).awaitTermination(120)
    got = {r.id: r.event_type for r in S.latest(spark.read.parquet(target)).collect()}
    assert got == {r.id: r.e for r in rows.groupBy("id").agg(F.max_by("event_type", "version").alias("e")).collect()}


def test_topics_and_link_health_files(spark):
    folder = tempfile.mkdtemp(prefix="topic-")
    with open(f"{folder}/a.json", "w") as f:
        f.write('{"url": "https://a", "n": 1}\nnot json\n')
    out = read_topic(spark, folder, "url string, n int", stream=False).cache().collect()
    assert {r.url for r in out} == {"https://a", None} and any(r._corrupt_record for r in out)
    health = spark.createDataFrame([("https://a", "dead"), ("https://b", "healthy")], "url string, status string")
    path = tempfile.mkdtemp(prefix="export-")
    export_link_health(health, path)
    new, counts = import_link_health(spark, path, "url string, status string", health.filter("url = 'https://a'"))
    assert [r.url for r in new.collect()] == ["https://b"] and tuple(counts.first()) == (1, 1, 0)


def test_ingest_stream_gives_the_graph_of_the_batch(spark):
    """Three files one after another, copies of payloads among them: the merged graph equals one batch over all, and every batch's account closes."""
    raw = _payloads(spark, SF).withColumn("fetched_at", F.to_timestamp("fetched_at")).withColumn("event_id", F.col("doc_id")).drop("doc_id")
    now = F.lit("2024-02-01T00:00:00+00:00")
    target, geo = tempfile.mkdtemp(prefix="ingest-"), _networks(spark, SF)
    path = landed(raw)
    stream = lambda: spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(path)
    checkpoint = tempfile.mkdtemp(prefix="check-")
    for _ in range(2):  # the second run has nothing to do
        S.ingest_stream(stream(), target, checkpoint, now, "30 days", geo=geo).awaitTermination(240)
        nodes, edges = G.read_graph(spark, f"{target}/graph")
        want = ingest(raw, now, geo=geo)
        kept = "label NOT IN ('MispEvent')"
        assert {(r.id, r.label) for r in nodes.filter(kept).collect()} == {(r.id, r.label) for r in want.nodes.filter(kept).collect()}
        for kind in ("MENTIONS", "LOCATED_IN"):
            assert {tuple(r) for r in edges.filter(F.col("type") == kind).collect()} == {tuple(r) for r in want.edges.filter(F.col("type") == kind).collect()}
        account = spark.read.parquet(f"{target}/account").groupBy("batch_id", "level", "kind").agg(F.sum(F.when(F.col("destination") == "in", F.col("n")).otherwise(-F.col("n"))).alias("left")).collect()
        assert account and all(r.left == 0 for r in account)
    uses = edges.filter("type = 'USES'")
    assert uses.count() > 0 and not dangling_edges(nodes, edges).count()


def test_ingest_accounts_for_everything_and_enriches(spark):
    """Payloads of every fate: null, broken, of no kind, empty, sent twice; items invalid or without an end; hashes, places, details and summaries."""
    feed = lambda *items: json.dumps({"feed_info": {"type": "RSS"}, "items": list(items)})
    long = "see " + "word " * 100
    md5, sha1 = "d" * 32, "e" * 40
    payloads = [None, None, "{bad", '{"a":1}', feed(), feed({"link": "https://a.example.com/1", "title": "t", "content": f"{md5} {sha1} 10.0.0.1 {long}"}, None), '{"indicators":[]}',
                '{"indicators":[{"value":"10.0.0.2","type":"ip"},{"value":"nope","type":"ip"},null]}',
                json.dumps({"type": "bundle", "objects": [{"id": "malware--12345678", "type": "malware", "name": "m"}, {"id": "", "type": "tool"}, {"id": "relationship--1", "type": "relationship", "relationship_type": "uses", "source_ref": "malware--12345678", "target_ref": "tool--old"}, {"id": "relationship--2", "type": "relationship", "relationship_type": "uses", "source_ref": "malware--12345678", "target_ref": "tool--none"}]})]
    raw = spark.createDataFrame([(f"https://x/{i}", "2024-01-01", p) for i, p in enumerate(payloads)] * 2, "url string, fetched_at string, payload string")
    known = spark.createDataFrame([("tool:old", "Tool", {"stix_id": "tool--old"})], "id string, label string, properties map<string,string>")
    geo = spark.createDataFrame([(0x0A000000, 0x0A0000FF, "Z")], "low long, high long, country string")
    details = spark.createDataFrame([("10.0.0.2", {"owner": "o", "type": "not this"})], "value string, details map<string,string>")
    out = ingest(raw, F.lit("2024-02-01T00:00:00+00:00"), geo, details, lambda s: s.str.len().astype(str), known)
    account = {}
    for r in out.account.collect():
        account.setdefault((r.level, r.kind), {})[r.destination] = r.n
    assert all(a["in"] == sum(n for d, n in a.items() if d != "in") for a in account.values())
    assert sum(a["in"] for (level, _), a in account.items() if level == "payload") == 2 * len(payloads)
    assert account["item", "misp_feed"] == {"in": 3, "graph": 1, "dead": 2} and account["item", "rss_feed"] == {"in": 2, "graph": 1, "dead": 1} and account["item", "stix_bundle"] == {"in": 4, "graph": 2, "dead": 2}
    nodes = {r.id: r for r in out.nodes.collect()}
    values = {r.properties.get("value") for r in nodes.values()}
    assert {md5, sha1, "10.0.0.1", "10.0.0.2"} <= values and [r.properties["owner"] for r in nodes.values() if r.properties.get("value") == "10.0.0.2"] == ["o"]
    assert [r.properties["summary"] for r in nodes.values() if r.label == "Article"] == [str(len(f"t\n{md5} {sha1} 10.0.0.1 {long}".strip()) + 1)]
    edges = {tuple(r) for r in out.edges.collect()}
    assert ("malware:m:12345678", "tool:old", "USES") in edges and sum(e[2] == "LOCATED_IN" for e in edges) == 2 and sum(e[2] == "USES" for e in edges) == 1
    assert sorted(r.error.message for r in out.dead.collect()) == sorted(["not JSON", "not JSON", "kind unknown", "no items", "no items", "no item", "invalid indicator", "invalid indicator", "no id or type", "end of relation not known"])


def test_merge_stream(spark):
    schema = "nodes array<struct<id:string,label:string,properties:map<string,string>>>, edges array<struct<source_id:string,target_id:string,type:string>>"
    rows = [([(f"n{i % 3}", "A", {"x": str(i)})], [("n0", f"n{i % 3}", "T")]) for i in range(6)]
    folder = tempfile.mkdtemp(prefix="merge-")
    S.merge_stream(in_files(spark, rows, schema, (2, 2, 2)), folder, tempfile.mkdtemp(prefix="check-")).awaitTermination(200)
    nodes, edges = G.read_graph(spark, folder)
    assert {r.id: r.properties["x"] for r in nodes.collect()} == {"n0": "3", "n1": "4", "n2": "5"} and edges.count() == 3

"""Changesets of mixed records: relations between entities, unknown shapes, odd values."""

import hashlib
import json

from sentryloom.operators import graph as G


def short(text, n=12):
    return hashlib.md5(text.encode()).hexdigest()[:n]


def test_relations_join_the_entities_of_their_record(spark):
    shape = "url string, title string, entities map<string,array<string>>, relations array<struct<source:string,target:string,type:string,confidence:double>>"
    both = {"tool": ["same"], "malware": ["same", "x"], "ip": None}
    rows = [
        ("https://h/1", "t", both, [("x", "other", "talks to", 0.9), ("x", "other", "talks to", 0.4), ("same", "x", None, None), ("", "x", "a", 1.0), (None, "x", "a", 1.0)]),
        ("https://h/2", "t", None, [("x", "other", "TALKS TO", 0.7)]),
        ("https://h/3", "t", {}, None),
    ]
    nodes, edges = G.relations_to_changeset(spark.createDataFrame(rows, shape))
    x, same, other = f"malware:{short('x')}", f"malware:{short('same')}", f"entity:{short('other')}"
    assert {tuple(r) for r in edges.collect()} == {(x, other, "TALKS_TO", 0.9), (same, x, "RELATED_TO", 0.5), (f"entity:{short('x')}", other, "TALKS_TO", 0.7)}
    assert {(r.id, r.label, r.properties["value"]) for r in nodes.collect()} == {(other, "Entity", "other"), (f"entity:{short('x')}", "Entity", "x")}


def test_no_edge_of_normalised_intelligence_hangs(spark):
    record = {"id": "n1", "entities": {"ip": ["10.0.0.1", ""], "cve": ["CVE-2024-1"]}, "relations": [{"source": "CVE-2024-1", "target": "10.0.0.1", "type": "seen at"}, {"source": "APT1", "target": "10.0.0.1"}], "raw_payload": {"title": "t"}}
    nodes, edges = G.to_changeset(spark.createDataFrame([(json.dumps(record),)], "record string"))
    ids = {r.id for r in nodes.collect()}
    assert {r.type for r in edges.collect()} == {"MENTIONS", "SEEN_AT", "RELATED_TO"} and all({r.source_id, r.target_id} <= ids for r in edges.collect())


def test_records_of_no_known_shape_are_raw(spark):
    records = [{"id": "r1", "a": 1, "b": {"c": [1, "x"]}, "n": None}, {"b": 2, "a": "y"}, {"a": "y", "b": 2}, {"source": "misp", "id": "no item"}, {"id": "", "z": True}]
    texts = [json.dumps(r) for r in records] + ["not json", "[1]", "", None]
    nodes, edges = G.to_changeset(spark.createDataFrame([(t,) for t in texts], "record string"))
    got = sorted((r.id, r.label, tuple(sorted(r.properties.items()))) for r in nodes.collect())
    assert len(got) == 5 and {label for _, label, _ in got} == {"RawIntel"} and edges.count() == 0
    named = {i: dict(p) for i, _, p in got}
    assert named["r1"] == {"id": "r1", "a": "1", "b": '{"c":[1,"x"]}'} and named["no item"] == {"source": "misp", "id": "no item"}
    assert sorted(i[:4] for i in named if i.startswith("raw:")) == ["raw:", "raw:"]  # equal records have one name


def test_an_empty_table_has_no_changes(spark):
    nodes, edges = G.to_changeset(spark.createDataFrame([], "record string"))
    assert nodes.count() == edges.count() == 0

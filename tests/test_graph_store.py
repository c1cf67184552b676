"""Graph tables that batches are merged into."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from sentryloom.streaming import graph_store as G

NODES, EDGES = "id string, label string, properties map<string,string>", "source_id string, target_id string, type string"


def batch(rng, n):
    nodes = [(rng.choice([f"n{rng.randint(0, 40)}", None]), rng.choice("AB"), rng.choice([None, {}, {rng.choice("xyz"): rng.choice([None, str(rng.randint(0, 99))])}, {"x": "1", "y": None}])) for _ in range(n)]
    return nodes, [(f"n{rng.randint(0, 9)}", f"n{rng.randint(0, 9)}", rng.choice("ST")) for _ in range(n)]


def frames(spark, parts):
    return spark.createDataFrame(parts[0], NODES), spark.createDataFrame(parts[1], EDGES)


def brute(batches):
    nodes, edges = {}, set()
    for number, (some, links) in enumerate(batches):
        for i, label, props in some:
            mine = nodes.setdefault((i, label), {})
            for k, v in (props or {}).items():
                if v is not None:
                    mine[k] = max(mine.get(k, (-1, "")), (number, v))
        edges |= set(links)
    return {k: {p: v for p, (_, v) in d.items()} for k, d in nodes.items()}, edges


def stored(spark, folder):
    nodes, edges = G.read_graph(spark, folder)
    rows, links = nodes.collect(), edges.collect()
    assert len({(r.id, r.label) for r in rows}) == len(rows) and len(set(links)) == len(links)
    return {(r.id, r.label): r.properties for r in rows}, {tuple(r) for r in links}


def on_disk(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_batches_merge_and_repeat_without_change(spark):
    folder, rng = tempfile.mkdtemp(prefix="graph-") + "/g", random.Random(5)
    assert stored(spark, folder) == ({}, set())
    batches = [batch(rng, 30) for _ in range(4)]
    for number, parts in enumerate(batches):
        assert G.merge_into(folder, *frames(spark, parts), number, partitions=8)
        assert not G.merge_into(folder, *frames(spark, parts), number)
        assert stored(spark, folder) == brute(batches[: number + 1])
    assert not G.merge_into(folder, *frames(spark, batch(rng, 5)), 2)
    assert stored(spark, folder) == brute(batches)


def test_only_touched_partitions_are_written_and_the_size_follows_the_graph(spark):
    folder, rng = tempfile.mkdtemp(prefix="graph-"), random.Random(6)
    first = batch(rng, 200)
    G.merge_into(folder, *frames(spark, first), 0, partitions=8)
    one, before = ([("n1", "A", {"x": "5"})], []), G.manifest(spark, folder)
    G.merge_into(folder, *frames(spark, one), 1)
    now = G.manifest(spark, folder)
    assert sum(before["nodes"][p] != at for p, at in now["nodes"].items()) == 1 and now["edges"] == before["edges"]
    sizes = []
    for number in range(2, 7):
        G.merge_into(folder, *frames(spark, first), number)
        sizes.append(on_disk(folder))
    assert max(sizes[1:]) < 1.2 * min(sizes[1:]) and len(os.listdir(f"{folder}/data")) <= 4


def test_a_batch_that_dies_before_its_manifest_leaves_the_graph_as_it_was(spark, monkeypatch):
    folder, rng = tempfile.mkdtemp(prefix="graph-"), random.Random(7)
    batches = [batch(rng, 20), batch(rng, 20)]
    G.merge_into(folder, *frames(spark, batches[0]), 0, partitions=4)
    with monkeypatch.context() as m:
        m.setattr(G.Files, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            G.merge_into(folder, *frames(spark, batches[1]), 1)
    assert stored(spark, folder) == brute(batches[:1])
    assert G.merge_into(folder, *frames(spark, batches[1]), 1) and stored(spark, folder) == brute(batches)

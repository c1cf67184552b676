"""Shortest paths from both ends against all paths of a brute-force search."""

import random

from sentryloom.operators import graph as G

KIND = "source_id string, target_id string"


def brute(edges, a, b, most):
    near = {}
    for x, y in edges:
        near.setdefault(x, set()).add(y)
        near.setdefault(y, set()).add(x)
    paths = [[a]]
    for _ in range(most + 1):
        if hit := [p for p in paths if p[-1] == b]:
            return [min(hit)]
        paths = [[*p, y] for p in paths for y in near.get(p[-1], ()) if y not in p]
    return []


def test_the_smallest_shortest_path_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(f"n{rng.randrange(14)}", f"n{rng.randrange(14)}") for _ in range(17)]
    edges += [*edges[:3], ("n0", "n0"), ("n1", None)]
    df = spark.createDataFrame(edges, KIND)
    whole = [e for e in edges if None not in e]
    for a, b, most in [("n0", "n1", 6), ("n2", "n9", 5), ("n3", "n12", 2), ("n4", "n4", 3), ("n0", "absent", 3)]:
        assert [r.path for r in G.shortest_path(df, a, b, most).collect()] == brute(whole, a, b, most)


def test_the_smaller_front_goes_on(spark, monkeypatch):
    """From a hub with 300 x 10 nodes around to the end of a chain: the nodes beyond the first ring are not visited."""
    rows, write = [], G.written

    def counted(df):
        out = write(df)
        if "path" in out.columns:
            rows.append(out.count())
        return out

    monkeypatch.setattr(G, "written", counted)
    edges = [("hub", f"l{i}") for i in range(300)] + [(f"l{i}", f"x{i}.{j}") for i in range(300) for j in range(10)] + [("hub", "n"), ("n", "m"), ("m", "b")]
    assert [r.path for r in G.shortest_path(spark.createDataFrame(edges, KIND), "hub", "b").collect()] == [["hub", "n", "m", "b"]]
    assert sum(rows) < 400

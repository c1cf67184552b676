"""Neighbours by inverted lists against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentryloom.operators import nearest as N
from sentryloom.operators.relations import knn


def brute(queries, corpus, k):
    out = {}
    unit = lambda v: np.array(v, float) / max(np.linalg.norm(v), 1e-12)
    for q, v in queries:
        sims = sorted((-float(unit(v) @ unit(w)), c) for c, w in corpus if c != q)[:k]
        out[q] = [(c, round(-s, 6)) for s, c in sims]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query", "rank").collect():
        out.setdefault(r["query"], []).append((r["neighbour"], round(r["cosine"], 6)))
    return out


def test_all_lists_are_the_exact_result_with_a_hot_vector(spark, monkeypatch):
    rng = np.random.default_rng(3)
    corpus = [(i, [1.0, 2.0, 0.5]) if i % 3 == 0 else (i, rng.normal(size=3).round(3).tolist()) for i in range(240)] + [(900, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(corpus, "vec_id long, embedding array<double>")
    queries = df.filter("vec_id % 20 = 0")
    got = result(N.knn_by_lists(queries, df.unionByName(spark.createDataFrame([(None, [1.0, 1.0, 1.0]), (901, None)], df.schema)), 4, recall=1.0, block_rows=16))
    want = brute([c for c in corpus if c[0] % 20 == 0], corpus, 4)
    assert {q: [s for _, s in v] for q, v in got.items()} == {q: [s for _, s in v] for q, v in want.items()}
    assert N.knn_by_lists(queries, df.limit(0), 3).collect() == []
    plan = N.knn_by_lists(queries, df, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_is_nine_tenths_or_more(spark, sf):
    e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    queries = e.filter("vec_id % 20 = 0")
    exact, got = (set(map(tuple, df.select("query", "neighbour").collect())) for df in (knn(queries, e, 5), N.knn_by_lists(queries, e, 5)))
    recall = len(exact & got) / len(exact)
    print(f"recall {recall:.3f}", N.fit_quantiser(e, int(e.count() ** 0.5), 5, "vec_id", "embedding")[1], int(e.count() ** 0.5))
    assert recall >= 0.9 and len(got) == len(exact)
    assert N.knn_by_lists(queries, e, 5).filter(F.col("cosine") > 1 + 1e-9).count() == 0

import math
from collections import Counter

import numpy as np
from sentryloom.llm.mixing import mix_sources, mixed_documents
from sentryloom.llm.sharding import _draw, communication_matrix, hypergeometric, shard_rows

from .conftest import edge_rows


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Resharing round by round, as the contract words it."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, list(names), share * sum(sizes.values())
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = [s for s in open_ if w[s] * unit > cap * sizes[s]]
        if not over:
            out.update({s: w[s] * unit for s in open_})
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def check_mix(df, buckets=50_000):
    rows = mix_sources(df, bucket_rows=buckets).collect()
    sizes = {}
    for r in rows:
        assert r.size == len((r.text or "").replace("\x0b", " ").split())
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size for r in mine)
        assert sum(r.taken for r in mine) == round(want[s])
    again = mix_sources(df, bucket_rows=buckets).collect()
    assert sorted((repr(r.doc_id), r.taken) for r in rows) == sorted((repr(r.doc_id), r.taken) for r in again)


def test_mix_meets_every_target(docs, edge):
    check_mix(docs)
    check_mix(docs, 7)
    check_mix(edge.withColumnRenamed("n_chars", "taken"))


def test_mix_of_nothing(empty, edge):
    assert mix_sources(empty).collect() == [] and mixed_documents(empty).collect() == []
    blank = edge.filter("text IS NULL OR text = ''")
    assert all(r.taken == 0 for r in mix_sources(blank).collect())


def test_mixed_documents_come_near_the_targets(docs):
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    for r in mix_sources(docs).select("source", "target").distinct().collect():
        longest = max(len(x.text.split()) for x in docs.filter(docs.source == r.source).collect())
        assert abs(got.get(r.source, 0) - r.target) <= longest


def check_shards(df, shards, **options):
    rows = shard_rows(df, shards, **options).collect()
    assert len(rows) == df.count()
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    counts = [len(v) for v in slots.values()]
    assert max(counts) - min(counts) <= 1
    again = shard_rows(df.repartition(5), shards, **options).collect()
    key = lambda r: (repr(r.doc_id), repr(r.text), r.shard, r.slot)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_shards_are_even_gapless_and_repeatable(docs, edge, empty):
    check_shards(docs, 24)
    check_shards(docs, 7, partitions=5, bucket_rows=6)
    check_shards(edge.withColumnRenamed("lang", "shard"), 4)
    assert len(edge_rows()) == edge.count()
    assert shard_rows(empty, 3).collect() == []


def test_repeated_ids_in_any_order_get_the_same_places(spark):
    """3000 rows of 500 ids that differ in text, a map, an array or nothing, in two orders."""
    schema = "doc_id long, text string, source string, tags map<string,int>, parts array<int>"
    data = [(k % 500 if k % 11 else None, f"text {k // 1000}" if k % 3 else None, f"s{k % 2}", {"a": k // 1500} if k % 5 else None, [k // 2000]) for k in range(3000)]
    one, two = spark.createDataFrame(data, schema).repartition(4), spark.createDataFrame(data[::-1], schema).repartition(7)
    for call, added in ((lambda d: shard_rows(d, 6, bucket_rows=100), ("shard", "slot")), (lambda d: mix_sources(d, bucket_rows=100), ("size", "taken"))):
        got = [Counter(repr([r[c] for c in (*one.columns, *added)]) for r in call(df).collect()) for df in (one, two)]
        assert got[0] == got[1]


def test_matrix_has_exact_margins_and_is_fair():
    sizes = [100, 0, 57, 343]
    sums = np.zeros((4, 6))
    for seed in range(300):
        m = communication_matrix(sizes, 6, seed)
        assert m.sum(axis=1).tolist() == sizes and (m >= 0).all() and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1
        sums += m
    assert np.allclose(sums / 300, np.array(sizes)[:, None] / 6, rtol=0.05, atol=0.5)
    big = _draw(np.random.default_rng(1), np.array([10**9, 2 * 10**9, 10**9]), 10**8)
    assert big.sum() == 10**8 and abs(big[1] - 5 * 10**7) < 10**5


def test_hypergeometric_draws_follow_their_law():
    """Frequencies against the exact law for small counts, mean and spread far beyond 1e9 rows."""
    rng = np.random.default_rng(4)
    for good, bad, n in ((7, 13, 9), (1, 30, 5), (40, 25, 60), (3, 0, 2), (0, 5, 3)):
        draws = 20_000
        got = np.bincount([hypergeometric(rng, good, bad, n) for _ in range(draws)], minlength=n + 1)
        want = np.array([math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) for k in range(n + 1)])
        assert got[want == 0].sum() == 0
        used = want > 0
        assert ((got[used] - draws * want[used]) ** 2 / (draws * want[used])).sum() < used.sum() + 6 * (2 * used.sum()) ** 0.5
    good, bad, n = 4 * 10**10, 6 * 10**10, 10**9
    x = np.array([hypergeometric(rng, good, bad, n) for _ in range(400)], float)
    sd = math.sqrt(n * 0.4 * 0.6 * (1 - n / (good + bad)))
    assert abs(x.mean() - 0.4 * n) < 5 * sd / 20 and 0.85 < x.std() / sd < 1.15

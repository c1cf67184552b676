"""The k articles that share most indicators, against all pairs, with lists that are hot."""

import random
from collections import Counter

import pytest
from sentryloom.operators import relations as R


def plain(rows, k):
    sets = {}
    for x, i in rows:
        if x is not None and i is not None:
            sets.setdefault(x, set()).add(i)
    out = set()
    for a, mine in sets.items():
        found = sorted((-len(mine & other), b) for b, other in sets.items() if b != a and mine & other)
        out |= {(a, b, -n, at) for at, (n, b) in enumerate(found[:k], 1)}
    return out


def mentions(seed, articles=70, rare=25, hot=4):
    rng = random.Random(seed)
    rows = [(a, f"r{rng.randrange(rare)}") for a in range(articles) for _ in range(rng.randrange(4))]
    rows += [(a, f"h{h}") for a in range(articles) for h in range(hot) if rng.random() < 0.5]
    return rows + rows[:20] + [(None, "h0"), (3, None), (900, "alone")]


@pytest.mark.parametrize("seed, hot, k", [(1, 10, 3), (2, 3, 1), (3, 0, 4), (4, 10_000, 3)])
def test_the_first_k_are_those_of_all_pairs(spark, seed, hot, k):
    rows = mentions(seed)
    got = R.related_content(spark.createDataFrame(rows, "article int, indicator string"), "article", "indicator", k, hot)
    assert {tuple(r) for r in got.select("a", "b", "shared", "rank").collect()} == plain(rows, k)


def test_a_list_of_all_articles_is_not_paired_with_itself(spark, monkeypatch):
    """Three hot indicators in 3000 articles: classes meet, not articles."""
    met = []
    pair = R.pairs_by_key
    monkeypatch.setattr(R, "pairs_by_key", lambda df, keys, item: met.append(df.count()) or pair(df, keys, item))
    rows = [(a, f"h{h}") for a in range(3000) for h in range(3) if a % (h + 2) < 1 or h == 0]
    got = R.related_content(spark.createDataFrame(rows, "article int, indicator string"), "article", "indicator", 2)
    out = {(r.a, r["rank"]): (r.b, r.shared) for r in got.collect()}
    sizes = Counter(a for a, _ in rows)
    assert met == [0, 8] and len(out) == 6000
    assert out[12, 1] == (0, 3) and out[0, 1] == (12, sizes[12]) and out[1, 1] == (0, 1)


def test_an_empty_table_relates_nothing(spark):
    assert R.related_content(spark.createDataFrame([], "article int, indicator string"), "article", "indicator", 3).count() == 0

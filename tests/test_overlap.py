"""Pairs that share one key alone are told where they meet; they and the others are all pairs, by brute force."""

import random
from collections import Counter
from itertools import combinations

import pytest

from sentryloom.operators import graph as G
from sentryloom.operators import relations as R
from sentryloom.tables import overlaps, signed


def brute(rows):
    sets = {}
    for x, i in rows:
        if x is not None and i is not None:
            sets.setdefault(x, set()).add(i)
    return {(a, b): n for a, b in combinations(sorted(sets), 2) if (n := len(sets[a] & sets[b]))}


def mentions(seed, kind):
    rng = random.Random(seed)
    rows = [(a, rng.randrange(90)) for a in range(60) for _ in range(rng.choice([1, 2, 5]))]
    # Articles with more keys than a signature has bits, and two that share only a few of them.
    rows += [(a, k) for a in (60, 61) for k in range(1000 * (a - 59), 1000 * (a - 59) + 400)] + [(61, 1000), (61, 1001), (62, 1000)]
    rows += rows[:40] + [(None, 1), (5, None)]
    return [(a if a is None else kind(a), i) for a, i in rows]


@pytest.mark.parametrize("kind", [int, lambda a: f"é{a}"])
@pytest.mark.parametrize("block", [4, 1024])
def test_both_kinds_of_pairs_are_all_pairs(spark, kind, block):
    rows = mentions(3, kind)
    m = signed(spark.createDataFrame(rows, f"article {'int' if kind is int else 'string'}, indicator int"), "article", "indicator").cache()
    one = [tuple(r) for r in overlaps(m, several=False, block=block).collect()]
    more = Counter(tuple(r) for r in overlaps(m, several=True, block=block).collect())
    assert len(set(one)) == len(one) and not set(one) & set(more)
    want = brute(rows)
    assert {**dict.fromkeys(one, 1), **more} == want
    assert sum(more.values()) < sum(want.values()) / 3


def test_repeated_mentions_count_once_in_cooccurrence(spark):
    rows = mentions(4, int)
    got = G.indicator_cooccurrence(spark.createDataFrame(rows, "article int, indicator int"), "article", "indicator").collect()
    assert {(r.a, r.b): r.shared for r in got} == brute(rows) and len(got) == len(brute(rows))


@pytest.mark.parametrize("hot", [3, 256])
def test_nearest_articles_among_many_that_share_one_indicator(spark, hot):
    rows = mentions(5, int) + [(a, 7) for a in range(60)]
    want = {}
    for (a, b), n in brute(rows).items():
        want.setdefault(a, []).append((-n, b))
        want.setdefault(b, []).append((-n, a))
    want = sorted((a, b, -n, i) for a, l in want.items() for i, (n, b) in enumerate(sorted(l)[:2], 1))
    got = R.related_content(spark.createDataFrame(rows, "article int, indicator int"), "article", "indicator", 2, hot)
    assert sorted((r.a, r.b, r.shared, r["rank"]) for r in got.collect()) == want

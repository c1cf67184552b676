"""Jaccard pairs of word shingles against all pairs, and what travels for them."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from sentryloom.operators import similarity as S
from sentryloom.plans.catalog import QUERIES

from .test_meeting import steps


def families(seed=3, families=6, each=14):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(400)]
    out = []
    for f in range(families):
        base = rng.choices(words, k=40 + 15 * f)
        for n in range(each):
            copy = list(base)
            for _ in range(n // 2):
                copy[rng.randrange(len(base))] = rng.choice(words)
            out.append(" ".join(copy + rng.choices(words, k=n % 3)))
    return out + [out[0], out[0].upper(), " " + out[20], "a b", "A  b", "ok", "", " ", "\t", None]


def by_hand(rows, threshold, k=5):
    reps = {}
    for key, text in rows:
        if text is not None:
            reps[text] = min(key, reps.get(text, key))
    sets = []
    for text, key in reps.items():
        words = text.strip(" ").lower().replace("\t", " ").split()
        sets.append((key, {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}))
    score = lambda x, y: len(x & y) / len(x | y)
    return {(a, b): score(x, y) for (a, x), (b, y) in itertools.combinations(sorted(sets, key=lambda s: s[0]), 2) if score(x, y) >= threshold}


@pytest.mark.parametrize(("threshold", "block"), [(0.4, 1024), (0.75, 8), (0.9, 3)])
def test_pairs_are_those_of_all_pairs_in_any_blocks(spark, monkeypatch, threshold, block):
    texts = [t for t in families() if t != "\t"]  # a lone tab splits into empty words, as in SQL
    rows = [(i, t) for i, t in zip(random.Random(1).sample(range(1000), len(texts)), texts, strict=True)]
    monkeypatch.setattr(S, "SETS_AT_ONCE", block)
    got = [(r.a, r.b, r.jaccard) for r in S.exact_jaccard_pairs(spark.createDataFrame(rows, "id long, t string"), "id", "t", threshold).collect()]
    want = by_hand(rows, threshold)
    assert {(a, b): j for a, b, j in got} == want and len(got) == len(want) > 10


def test_a_pair_just_at_the_threshold_is_found(spark):
    """0.55 * 100 is a little more than 55 in floating point."""
    long, short = " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(55))
    df = spark.createDataFrame([("x", long), ("y", short), ("z", "w1 w2"), (None, short)], "id string, t string")
    assert [tuple(r) for r in S.exact_jaccard_pairs(df, "id", "t", 0.55, k=1).collect()] == [("x", "y", 0.55)]


def test_null_is_no_empty_text(spark, tmp_path):
    """A null text has no pair and does not stand for the empty one, which pairs with a blank one."""
    spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, ""), (5, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in QUERIES["exact_jaccard_pairs"](spark, str(tmp_path)).collect()] == [(2, 3, 1.0)]


def test_sets_travel_to_their_group_and_pairs_do_not(spark, monkeypatch):
    """60 near copies make 1770 pairs; each set is dealt once, and no pair is joined or shuffled."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:i], f"x{i}", *words[i:]])) for i in range(60)]
    dealt, meet = [], S.met_in_blocks
    monkeypatch.setattr(S, "met_in_blocks", lambda df, *more: dealt.append(df.agg(F.count(F.lit(1)), F.count_distinct("_g")).first()) or meet(df, *more))
    pairs = S.exact_jaccard_pairs(spark.createDataFrame(rows, "id long, t string"), "id", "t", 0.75)
    plan = steps(pairs)
    assert not any("Join" in x or "Exchange" in x or "Aggregate" in x for x in plan[: plan.index("MapInArrow")])
    assert pairs.count() == 1770 and [tuple(x) for x in dealt] == [(60, 1)]

"""Rows that meet by shared buckets: each pair once, scored where it is met, and no pair is shuffled."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from sentryloom import tables
from sentryloom.operators import records
from sentryloom.operators import similarity as S


def steps(df):
    """The operators of the plan, the last step first."""
    return [line.strip(" +-:*()0123456789").split("(")[0].split(" ")[0] for line in df._jdf.queryExecution().sparkPlan().toString().splitlines()]


def fingerprints(spark, n=160, slots=128, seed=7):
    rng = random.Random(seed)
    bases = [[rng.randrange(-(1 << 62), 1 << 62) for _ in range(slots)] for _ in range(5)]
    rows = []
    for i in range(n):
        change = rng.choice([0.02, 0.15, 0.25, 0.3])
        signature = [rng.randrange(1 << 40) if rng.random() < change else v for v in bases[i % 5]]
        rows.append((i, signature, 0 if i % 11 == 0 else rng.getrandbits(63) & ~0xFFFF | i % 3))
    return rows, spark.createDataFrame(rows, "id long, signature array<long>, simhash long")


def by_hand(rows, threshold, bands=16):
    each, out = len(rows[0][1]) // bands, {}
    for (a, sa, ha), (b, sb, hb) in itertools.combinations(rows, 2):
        band = any(sa[i * each : (i + 1) * each] == sb[i * each : (i + 1) * each] for i in range(bands))
        block = ha and hb and any((ha ^ hb) >> 16 * i & 65_535 == 0 for i in range(4))
        score = 0.7 * (sum(x == y for x, y in zip(sa, sb, strict=True)) / len(sa)) + 0.3 * (1 - (ha ^ hb).bit_count() / 64)
        if (band or block) and score >= threshold:
            out[a, b] = round(score, 9)
    return out


@pytest.mark.parametrize("slots", [128, 100, 20])
def test_similar_pairs_are_those_of_the_buckets(spark, monkeypatch, slots):
    rows, fp = fingerprints(spark, slots=slots)
    monkeypatch.setattr(tables.met_in_blocks, "__defaults__", (16,))
    got = [(r.a, r.b, round(r.score, 9)) for r in S.similar_pairs(fp, "id", 0.6).collect()]
    want = by_hand(rows, 0.6)
    assert {(a, b): s for a, b, s in got} == want and len(got) == len(want) > 500


def test_pairs_are_not_shuffled(spark):
    fp = fingerprints(spark, 40)[1]
    similar = steps(S.similar_pairs(fp, "id", 0.6))
    assert "MapInArrow" in similar and not any("Join" in x or "Exchange" in x or "Aggregate" in x for x in similar[: similar.index("MapInArrow")])
    candidates = steps(S.candidate_pairs(S.simhash_buckets(fp, "id"), "id"))
    join = next(i for i, x in enumerate(candidates) if "Join" in x)
    assert not any("Exchange" in x or "Aggregate" in x for x in candidates[:join])


def test_candidates_of_several_common_buckets_are_told_once(spark):
    rng = random.Random(2)
    rows = [(i, band, f"{rng.randrange(4)}") for i in range(90) for band in range(3)]
    got = [tuple(r) for r in S.candidate_pairs(spark.createDataFrame([*rows, *rows[:9]], "id long, band int, bucket string"), "id").collect()]
    at = {i: {(b, x) for j, b, x in rows if j == i} for i in range(90)}
    assert sorted(got) == [(a, b) for a, b in itertools.combinations(range(90), 2) if at[a] & at[b]]


def test_each_two_rows_of_a_key_meet_once_in_any_number_of_blocks(spark):
    df = spark.range(50).select(F.col("id").alias("key"), (F.col("id") % 2).alias("k"))
    met = [tuple(sorted((r.a_key, r.b_key))) for r in tables.meet(df, ["k"], ["key"], lambda a, b: F.lit(True), block=4).collect()]
    assert sorted(met) == [(a, b) for a, b in itertools.combinations(range(50), 2) if (a - b) % 2 == 0]


@pytest.mark.parametrize("dense", [True, False])
def test_the_exact_way_by_lists_or_by_all_rows(spark, dense):
    rng = random.Random(4)
    base = [rng.getrandbits(60) for _ in range(128)]
    rows = [(i, [v if rng.random() < 0.9 else rng.getrandbits(60) for v in base] if dense or i % 10 == 0 else [rng.getrandbits(60) for _ in base], rng.getrandbits(63)) for i in range(80)]
    got = {(r.a, r.b): round(r.score, 9) for r in S.exact_similar_pairs(spark.createDataFrame(rows, "id long, signature array<long>, simhash long"), "id", 0.7).collect()}
    score = lambda x, y: 0.7 * sum(p == q for p, q in zip(x[1], y[1], strict=True)) / 128 + 0.3 * (1 - (x[2] ^ y[2]).bit_count() / 64)
    assert got == {(x[0], y[0]): round(score(x, y), 9) for x, y in itertools.combinations(rows, 2) if score(x, y) >= 0.7} and got


def test_tasks_that_pair_rows_are_not_put_together_by_bytes(spark):
    buckets = spark.range(60).select("id", F.lit(0).alias("band"), (F.col("id") % 3).cast("string").alias("bucket"))
    found = S.candidate_pairs(buckets, "id")
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1 and found.count() == 3 * 190


def test_one_text_of_each_is_found_without_a_shuffle_of_texts(spark):
    rows = [(4, "x"), (2, "x"), (9, "x"), (5, None), (7, ""), (3, "y"), (3, "z"), (8, "z"), (1, "y")]
    one = S.one_of_each(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    assert sorted(tuple(r) for r in one.collect()) == [(1, "y"), (2, "x"), (3, "z"), (5, None)]
    plan = steps(one)
    assert "BroadcastHashJoin" in plan and not any("Aggregate" in x or "Exchange" in x for x in plan)


def test_duplicate_flag_counts_known_rows_only(spark):
    rows, fp = fingerprints(spark)
    want = by_hand(rows, 0.6)
    flags = {r.id: (r.matches, round(r.best, 9), r.duplicate) for r in records.duplicate_flag(fp.filter("id % 4 = 0"), fp.filter("id % 4 <> 0"), "id", 0.6).collect()}
    for i in range(0, 160, 4):
        scores = [s for (a, b), s in want.items() if (a == i and b % 4) or (b == i and a % 4)]
        assert flags[i] == (len(scores), max(scores, default=0.0), bool(scores))

"""Pairs of packed rows: most are told apart by a product, those of small keys go together, and best matches are added up in the task."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentryloom import tables
from sentryloom.operators import similarity as S

PLANES, SLOTS = 3, 100
WORDS = [(f"v_{w}", [f"p{i}_{w}" for i in range(PLANES)]) for w in range(2)]


def made(n, seed=1, families=40, change=0.15):
    """Numbers of slots (0: none) and SimHashes of families of near rows."""
    rng = np.random.default_rng(seed)
    of = rng.integers(0, families, n)
    numbers = rng.integers(0, 1 << PLANES, (families, SLOTS))[of]
    numbers = np.where(rng.random(numbers.shape) < change, rng.integers(0, 1 << PLANES, numbers.shape), numbers)
    sims = rng.integers(0, 1 << 64, families, np.uint64)[of] ^ (rng.integers(0, 1 << 64, n, np.uint64) & rng.integers(0, 1 << 64, n, np.uint64) & rng.integers(0, 1 << 64, n, np.uint64))
    return numbers, sims


def batch(numbers, sims, **more):
    columns = {"key": np.arange(len(sims)), "s": sims.view(np.int64), **more}
    for w, (v, planes) in enumerate(WORDS):
        part = numbers[:, 64 * w : 64 * w + 64].astype(np.uint64)
        put = lambda bits: np.bitwise_or.reduce(bits.astype(np.uint64) << np.arange(bits.shape[1], dtype=np.uint64), axis=1).view(np.int64)
        columns[v] = put(part > 0)
        columns |= {p: put(part >> np.uint64(i) & np.uint64(1)) for i, p in enumerate(planes)}
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def scores(numbers, sims):
    same = np.stack([((numbers == row) & (row > 0)).sum(1) for row in numbers])
    return 0.7 * (same / SLOTS) + 0.3 * (1 - np.bitwise_count(sims[:, None] ^ sims[None, :]) / 64)


@pytest.fixture
def compared(monkeypatch):
    counts, plain = [], S._compared
    monkeypatch.setattr(S, "_compared", lambda a, b, x, y, *more: counts.append(len(x)) or plain(a, b, x, y, *more))
    return counts


@pytest.mark.parametrize(("threshold", "share"), [(0.8, 0.05), (0.6, 0.2)])
def test_few_pairs_are_compared_and_none_is_lost(compared, threshold, share):
    numbers, sims = made(3000)
    numbers[:400] = 0  # rows without numbers agree with none
    want = scores(numbers, sims)
    rows = batch(numbers, sims)
    for a, b in ((rows, rows), (rows.slice(0, 1300), rows.slice(1300))):
        compared.clear()
        got = [r for out in S._scored(WORDS, SLOTS, threshold).blocks(a, b) for r in zip(*(c.to_pylist() for c in out.columns), strict=True)]
        x, y = np.nonzero(np.triu(want >= threshold, 1) if a is b else want[:1300, 1300:] >= threshold)
        y = y if a is b else y + 1300
        assert {(p, q): s for p, q, s in got} == {(int(p), int(q)): want[p, q] for p, q in zip(x, y, strict=True)} and len(got) == len(x) > 15
        assert sum(compared) < share * a.num_rows * b.num_rows / (2 if a is b else 1)


@pytest.mark.parametrize("little", [False, True])
def test_best_matches_leave_a_row_for_each_that_asks(little):
    numbers, sims = made(900, families=9)
    rng = np.random.default_rng(5)
    asks, counts = rng.random(900) < 0.3, np.where(rng.random(900) < 0.6, rng.integers(1, 9, 900), 0)
    want = np.where((scores(numbers, sims) >= 0.75) & ~np.eye(900, dtype=bool), scores(numbers, sims), 0)
    rows = batch(numbers, sims, asks=asks, counts=counts)
    pairing = S._best(WORDS, SLOTS, 0.75, 0)
    outs = [list(pairing.few(rows, *np.triu_indices(900, 1)))] if little else [list(pairing.blocks(rows, rows)), list(pairing.blocks(rows.slice(0, 400), rows.slice(400)))]
    got = {k: (s, n) for out in outs[0] for k, s, n in zip(*(c.to_pylist() for c in out.columns), strict=True)}
    assert got == {i: (want[i][counts > 0].max(), counts[want[i] > 0].sum()) for i in range(900) if asks[i] and counts[want[i] > 0].sum()} and len(got) > 100
    if not little:
        assert sum(out.num_rows for out in outs[1]) <= asks.sum()
        across = np.zeros_like(want, bool)
        across[:400, 400:] = across[400:, :400] = True
        assert {k: n for out in outs[1] for k, n in zip(out["key"].to_pylist(), out["matches"].to_pylist(), strict=True)} == {i: n for i in range(900) if asks[i] and (n := counts[(want[i] > 0) & across[i]].sum())}


def test_keys_of_few_rows_go_together(spark, monkeypatch):
    """Each pair once, whether its key has few rows, or is cut by a batch, or has a block too many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 90)
    try:
        df = spark.range(1200).select(F.col("id").alias("key"), F.when(F.col("id") < 900, F.floor(F.col("id") / 4)).otherwise(-1).alias("k"))
        told = lambda how: lambda a, b, *at: iter([pa.RecordBatch.from_arrays([p, q, pa.array([how] * len(p))], names=["a", "b", "how"]) for p, q in [at_of(a, b, *at)]])

        def at_of(a, b, *at):
            if at:
                return a["key"].take(pa.array(b)), a["key"].take(pa.array(at[0]))
            x, y = np.triu_indices(len(a), 1) if a is b else np.divmod(np.arange(len(a) * len(b)), len(b))
            return a["key"].take(pa.array(x)), b["key"].take(pa.array(y))

        pairing = tables.Pairing(told("blocks"), told("few"))
        got = tables.met_in_blocks(df, ["k"], ["key"], pairing, "a long, b long, how string", 128).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(sorted((r.a, r.b))) for r in got) == sorted([(i, j) for i in range(900) for j in range(i + 1, i // 4 * 4 + 4)] + [(i, j) for i in range(900, 1200) for j in range(i + 1, 1200)])
    assert sum(r.how == "few" for r in got if r.a < 900) > 0.8 * 225 * 6

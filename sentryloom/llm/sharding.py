"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are dealt to P source partitions by a hash of their id.  The driver draws how many
rows each partition sends to each shard (P x S counts, from the partition sizes alone), so
that shard sizes are exact.  Each partition is permuted and cut by its row of the matrix,
rows go to their shards, and each shard is permuted again.  DataFrame operations only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import BUCKET_ROWS, TIES, n_buckets, named_apart, prefix_sums, renamed_apart, with_row_order

PARTITIONS = 64
INTERNAL = ["_p", "_k1", "_k2", "_b", "_x", "_offset", "_r", "_cuts", *TIES]
#: Standard deviations on each side of the mode within which a count is drawn; what lies beyond has no weight in double precision.
SPREAD = 12


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n rows drawn without replacement from ``good + bad`` are good, at any size.

    One uniform number against the summed weights around the mode.  Weights follow from the
    ratios of neighbours, ``(good - k)(n - k) / ((k + 1)(bad - n + k + 1))``, so no factorial
    is approximated, and the window grows only with the standard deviation.
    """
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = (n + 1) * (good + 1) // (total + 2)
    sd = (n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    reach = int(SPREAD * sd) + 64
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weights = np.concatenate([[0.0], np.cumsum(steps)])
    sums = np.cumsum(np.exp(weights - weights.max()))
    return low + int(np.searchsorted(sums, rng.random() * sums[-1], "right"))


def _draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """How many of n rows go to each shard that has ``left`` free slots: one shard after another from what remains."""
    out, rest = np.zeros_like(left), int(left.sum())
    for s, free in enumerate(map(int, left)):
        out[s] = hypergeometric(rng, free, rest - free, n)
        n, rest = n - int(out[s]), rest - free
    return out


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Counts [partition, shard]: rows sum to ``sizes``, columns to shard sizes at most one apart."""
    rng = np.random.Generator(np.random.PCG64(seed))
    total = sum(sizes)
    left = np.full(shards, total // shards, np.int64)
    left[rng.permutation(shards)[: total % shards]] += 1
    matrix = np.zeros((len(sizes), shards), np.int64)
    for p, n in enumerate(sizes):
        matrix[p] = _draw(rng, left, n)
        left -= matrix[p]
    return matrix


def shard_rows(docs: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id", partitions: int = PARTITIONS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in its shard).

    Shard sizes differ by one at most.  The result follows from the rows and the seed
    alone: reruns and lost executors give the same places.  Null ids and repeated rows are
    placed like any other (rows that are alike in id are ordered by a hash of all their
    columns, the text too, so only equal rows may change places with each other);
    null, empty and long texts need no care, an empty table gives an empty result, and
    input columns named like the outputs are replaced.
    """
    docs, names_back, (id_col,) = named_apart(renamed_apart(docs, ["shard", "slot"]), INTERNAL, id_col)
    ties = [id_col, *TIES]
    keyed = with_row_order(docs).withColumns({"_p": F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(partitions)).cast("int"), "_k1": F.xxhash64(F.lit(seed + 1), id_col), "_k2": F.xxhash64(F.lit(seed + 2), id_col)})
    sizes = dict(keyed.groupBy("_p").count().collect())  # at most `partitions` rows
    total = sum(sizes.values())
    matrix = communication_matrix([sizes.get(p, 0) for p in range(partitions)], shards, seed)
    cuts = matrix.cumsum(axis=1)
    deal = docs.sparkSession.createDataFrame([(p, [int(x) for x in cuts[p]]) for p in range(partitions)], "_p int, _cuts array<long>")
    one = F.lit(1)
    placed = prefix_sums(keyed, ["_p"], "_k1", ties, one, n_buckets(total // partitions, bucket_rows), "_r", lambda sums: F.broadcast(deal))
    placed = placed.withColumn("shard", F.size(F.filter("_cuts", lambda c: c <= F.col("_r"))).cast("int")).drop("_r", "_cuts", "_p", "_k1")
    return names_back(prefix_sums(placed, ["shard"], "_k2", ties, one, n_buckets(total // shards, bucket_rows), "slot").drop("_k2", *TIES))

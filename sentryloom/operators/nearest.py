"""Nearest neighbours by inverted lists of a coarse quantiser, re-ranked exactly; ``relations.knn`` is the exhaustive way."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import written

#: Rows that the quantiser is fitted on: those with the smallest hash of their key.
SAMPLE = 20_000
#: Inverted lists at most, so centroids (lists x dimensions) are of bounded size.
LISTS = 4096
#: Share of neighbours that the probed lists of sampled queries must hold.
RECALL = 0.95
SAMPLE_QUERIES = 500
BLOCK_ROWS = 1024


def _unit(rows: pa.Array) -> np.ndarray:
    """Vectors as rows of length 1; a zero vector stays zero."""
    m = np.array(rows.to_pylist(), np.float64).reshape(len(rows), -1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def fit_quantiser(vectors: DataFrame, lists: int, k: int, key: str, vector: str, recall: float = RECALL, sample: int = SAMPLE, rounds: int = 8) -> tuple[np.ndarray, int]:
    """Centroids by spherical k-means on a bounded sample, and how many lists a query has to probe.

    Copies of one vector count once, so a vector that makes up much of the table gets one
    list.  That many lists hold the ``recall`` share of the k nearest sampled rows of sampled
    rows; neighbours in the whole table are nearer still.  The same rows give the same.
    """
    rows = vectors.select(vector, F.xxhash64(F.lit(11), key).alias("_h"), key).orderBy("_h", key).limit(sample).toArrow()
    if not rows.num_rows:
        return np.zeros((0, 0)), 0
    m = np.unique(_unit(rows[vector].combine_chunks()), axis=0)
    m = m[np.random.default_rng(7).permutation(len(m))]
    centers = m[:lists].copy()
    for _ in range(rounds):
        near = (m @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, m)
        some = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(some > 1e-9, sums / np.maximum(some, 1e-12), centers)
    sims = m[:SAMPLE_QUERIES] @ m.T
    np.fill_diagonal(sims, -2.0)
    nearest = np.argsort(-sims, axis=1, kind="stable")[:, : min(k, max(0, len(m) - 1))]
    place = np.argsort(np.argsort(-(m[:SAMPLE_QUERIES] @ centers.T), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, (m @ centers.T).argmax(axis=1)[nearest], 1).ravel()
    return centers, int(np.quantile(needed, recall, method="higher")) + 1 if len(needed) else len(centers)


def knn_by_lists(queries: DataFrame, corpus: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", lists: int | None = None, recall: float = RECALL, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query, neighbour, cosine, rank``: the k nearest corpus rows of each query by cosine (ties: the smaller key) among those in the lists it probes.

    Every corpus row is in the list of its nearest centroid; a query asks the lists whose
    centroids are nearest, as many as hold the ``recall`` share of neighbours in a sample of at
    most ``sample`` rows on which centroids are fitted too (1.0: all lists, the exact result).  A list is cut into blocks of about
    ``block_rows`` rows by a hash of the key, queries of a list as well, and blocks of one list
    meet in a join on the list: a list that holds a third of all rows is many blocks and no
    list is held whole.  Keys are whole numbers; a row is not its own neighbour; null keys and
    vectors are left out; an empty table gives no rows.
    """
    usable = lambda df: df.select(F.col(key).cast("long").alias("_id"), F.col(vector).alias("_v")).filter("_id IS NOT NULL AND _v IS NOT NULL")
    rows, asked = usable(corpus), usable(queries)
    n = rows.count()
    centers, many = fit_quantiser(rows, lists or min(LISTS, max(1, int(n**0.5))), k, "_id", "_v", recall, sample)
    shape = "query long, neighbour long, cosine double, rank int"
    spark = corpus.sparkSession
    if not len(centers):
        return spark.createDataFrame([], shape)
    known = spark.sparkContext.broadcast(centers)
    many = len(centers) if recall >= 1 else min(len(centers), many)

    def listed(most: int):
        def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sims = _unit(batch.column(1)) @ known.value.T
                near = np.argsort(-sims, axis=1, kind="stable")[:, :most]
                at = pa.array(np.repeat(np.arange(len(near)), near.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), batch.column(0).take(at), batch.column(1).take(at)], names=["_list", "_id", "_v"])

        return put

    def packed(df: DataFrame, name: str, most: int) -> DataFrame:
        schema = T.StructType([T.StructField("_list", T.IntegerType()), *df.schema.fields])
        placed = df.mapInArrow(listed(most), schema)
        placed = written(placed)
        sizes = placed.groupBy("_list").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("_blocks"))  # at most LISTS rows
        placed = placed.join(F.broadcast(sizes), "_list").withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")))

        def pack(table: pa.Table) -> pa.Table:
            table = table.sort_by("_id")
            return pa.table({"_list": table["_list"][:1], f"{name}_ids": [table["_id"].to_numpy().tobytes()], f"{name}_m": [_unit(table["_v"].combine_chunks()).tobytes()]})

        return placed.groupBy("_list", "_block").applyInArrow(pack, f"_list int, {name}_ids binary, {name}_m binary")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, qi, qm, ci, cm in zip(*batch.to_pydict().values(), strict=True):
                q, c = np.frombuffer(qi, np.int64), np.frombuffer(ci, np.int64)
                sims = np.frombuffer(qm).reshape(len(q), -1) @ np.frombuffer(cm).reshape(len(c), -1).T
                sims[q[:, None] == c[None, :]] = -2.0
                top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                found = np.take_along_axis(sims, top, 1).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(q, top.shape[1])[found > -2], c[top].ravel()[found > -2], found[found > -2])], names=["query", "neighbour", "cosine"])

    pairs = packed(asked, "q", many).join(packed(rows, "c", 1), "_list").select("_list", "q_ids", "q_m", "c_ids", "c_m")
    near = pairs.mapInArrow(best, "query long, neighbour long, cosine double")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), "neighbour"))
    return near.withColumn("rank", nth).filter(F.col("rank") <= k)

"""Blocked Bloom filters of 64-bit hashes: filled by tasks, of a fixed largest size, given to every task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS_PER_KEY = 24
#: Bytes of a filter that one task fills.
CHUNK_BYTES = 1 << 20

_U = np.uint64


def n_blocks(keys: int, most_bytes: int) -> int:
    return max(1, -(-int(keys * min(float(BITS_PER_KEY), 8 * most_bytes / max(1, keys))) // 64))


def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and the five bits that it sets there."""
    block = ((hashes >> _U(32)) * _U(blocks)) >> _U(32)
    bits = np.zeros(len(hashes), np.uint64)
    for k in range(5):
        bits |= _U(1) << ((hashes >> _U(6 * k)) & _U(63))
    return block.astype(np.int64), bits


def has(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    block, bits = places(hashes, len(filled))
    return filled[block] & bits == bits


def filled(keys: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], count: int, most_bytes: int) -> np.ndarray:
    """The filter of the rows of ``keys``, at most ``most_bytes``; beyond that it lets more through."""
    blocks, size = n_blocks(count, most_bytes), CHUNK_BYTES // 8

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = places(hashes(batch), blocks)
            yield pa.RecordBatch.from_arrays([pa.array(block // size), pa.array(block % size), pa.array(bits.view(np.int64))], names=["_chunk", "_block", "_bits"])

    def fill(table: pa.Table) -> pa.Table:
        out = np.zeros(size, np.uint64)
        np.bitwise_or.at(out, table["_block"].to_numpy(), table["_bits"].to_numpy().view(np.uint64))
        return pa.table({"_chunk": table["_chunk"][:1], "_data": pa.array([out.tobytes()])})

    out = np.zeros(-(-blocks // size) * size, np.uint64)
    for row in keys.mapInArrow(placed, "_chunk long, _block long, _bits long").groupBy("_chunk").applyInArrow(fill, "_chunk long, _data binary").collect():
        out[row["_chunk"] * size : (row["_chunk"] + 1) * size] = np.frombuffer(row["_data"], np.uint64)
    return out[:blocks]

"""Token ids packed into rows of fixed width by best-fit decreasing, as binary matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._transducer import compile_tokenizer, transducer

WIDTH = 2048
#: Tokens that a task gathers before it packs them; a row holds segments of one such group.
GROUP_TOKENS = 1024 * WIDTH
#: Rows of the result that leave a task at a time.
OUT_ROWS = 128


class CapacityTree:
    """A segment tree over free capacities: the smallest capacity of at least x that some open row has."""

    def __init__(self, width: int) -> None:
        self.leaves = 1 << width.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def _add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.open[node] += n
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes and gives (capacity, row) of the tightest row that fits."""
        node = self.leaves + least
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: np.ndarray, width: int) -> list[list[int]]:
    """Rows of item numbers; no row holds more than ``width``, ties go by item number."""
    tree, rows = CapacityTree(width), []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        got = tree.take(size)
        if got is None:
            got = width, len(rows)
            rows.append([])
        rows[got[1]].append(item)
        if got[0] > size:
            tree.put(got[0] - size, got[1])
    return rows


def pack_tokens(docs: DataFrame, tokenizer: str, width: int = WIDTH, pad_id: int = 0, group_tokens: int = GROUP_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``width`` token ids that hold every token of every text once.

    A text longer than ``width`` is split into segments without loss, numbered from 0.
    ``token_ids`` is a matrix row of ``width`` little-endian 32-bit ids filled up with
    ``pad_id`` after ``n_tokens``; ``position_ids`` are 32-bit positions that begin again
    at 0 with each segment (and with the padding); ``cu_seqlens`` are the cumulative
    segment lengths from 0 to ``n_tokens``; ``doc_ids`` and ``segment_numbers`` name the
    segments in order.  Null and empty texts have no tokens and no segment.  Repeated rows
    are packed each; ids may be of any type, a null id is kept as null; an empty table gives no rows; other input
    columns are not read.  Each task packs groups of bounded size from its own partition:
    there is no shuffle, and a lost task packs the same rows again.
    """
    classes = compile_tokenizer(tokenizer)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kinds = {"pack_id": T.LongType(), "n_tokens": T.IntegerType(), "doc_ids": T.ArrayType(rows.schema["_id"].dataType), "segment_numbers": T.ArrayType(T.IntegerType()), "cu_seqlens": T.ArrayType(T.IntegerType()), "token_ids": T.BinaryType(), "position_ids": T.BinaryType()}
    schema = T.StructType([T.StructField(k, v) for k, v in kinds.items()])

    def filled(parts: list[np.ndarray]) -> tuple[int, list[int], bytes, bytes]:
        """Tokens, cumulative lengths, ids and positions of a row."""
        lengths = np.array([len(x) for x in parts])
        total, starts = int(lengths.sum()), np.cumsum(lengths) - lengths
        ids, positions = np.full(width, pad_id, "<i4"), np.arange(width, dtype="<i4")
        ids[:total] = np.concatenate(parts)
        positions[:total] -= np.repeat(starts, lengths).astype("<i4")
        positions[total:] -= total
        return total, [*starts.tolist(), total], ids.tobytes(), positions.tobytes()

    def packed(group: list[tuple[object, int, np.ndarray]], first: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        plan = best_fit_decreasing(np.array([len(x[2]) for x in group]), width)
        types = (pa.int64(), pa.int32(), pa.list_(id_type), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary())
        for low in range(0, len(plan), OUT_ROWS):
            out = []
            for number, items in enumerate(plan[low : low + OUT_ROWS], first + low):
                total, ends, ids, positions = filled([group[i][2] for i in items])
                out.append((number, total, [group[i][0] for i in items], [group[i][1] for i in items], ends, ids, positions))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(types)], names=list(kinds))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer, classes)
        group: list[tuple[object, int, np.ndarray]] = []
        held, at, id_type = 0, TaskContext.get().partitionId() << 33, pa.null()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, ids in zip(batch.column(0).to_pylist(), machine.token_ids(batch.column(1).to_pylist()), strict=True):
                for k in range(0, len(ids), width):
                    group.append((key, k // width, ids[k : k + width].astype("<i4")))
                    held += len(group[-1][2])
                    if held >= group_tokens:
                        yield from packed(group, at, id_type)
                        at += len(group)  # at least as many as the rows just written
                        group, held = [], 0
        if group:
            yield from packed(group, at, id_type)

    return rows.mapInArrow(pack, schema)

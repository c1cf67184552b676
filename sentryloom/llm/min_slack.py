"""Documents packed into as few sequences as possible by minimum bin slack.

The plan of the bins depends only on how many pieces there are of each length, at most
``capacity`` numbers whatever the size of the corpus.  Bin by bin, the longest piece left
opens the bin, and a subset-sum dynamic program over the available lengths (one bit for
each sum, a shift for each number of copies) finds the fullest combination for the rest of
it.  The combination is removed as often as its lengths allow, which are the same bins that
one search after another would make.

Pieces take their places by number: each scan task numbers its pieces of each length, the
counts of (task, length) give the number in the whole table, and the plan says which
numbers of a length go to which sequences.  No piece is sorted or moved for that.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._spark import small, written
from ._transducer import compile_tokenizer, transducer

CAPACITY = 1024
#: Bytes of token ids that leave a task at a time.
OUT_BYTES = 4 << 20

Pattern = list[tuple[int, int]]


def fullest(lengths: list[tuple[int, int]], room: int) -> Pattern:
    """The combination of (length, count), given from long to short, with the largest sum up to ``room``: (length, copies) pairs.

    Bit s of ``reach[i]`` says that the first i lengths have a combination of sum s.  Shorter
    lengths are not looked at once the room can be filled, so they stay for later bins.
    """
    mask, reach, used = (1 << (room + 1)) - 1, [1], []
    for length, count in lengths:
        if reach[-1] >> room & 1:
            break
        bits, left, step = reach[-1], min(count, room // length), 1
        while left > 0:
            copies = min(step, left)
            bits |= bits << (copies * length) & mask
            left, step = left - copies, 2 * step
        used.append(length)
        reach.append(bits)
    total, out = reach[-1].bit_length() - 1, []
    for i in range(len(used) - 1, -1, -1):
        copies = 0
        while not reach[i] >> total & 1:
            total, copies = total - used[i], copies + 1
        if copies:
            out.append((used[i], copies))
    return out[::-1]


def min_slack_plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Combinations of lengths and how many bins each fills; together they hold ``counts`` exactly."""
    left, plan = {x: n for x, n in counts.items() if n > 0}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        rest = fullest([(x, left[x]) for x in sorted(left, reverse=True) if left[x] and x <= capacity - longest], capacity - longest)
        left[longest] += 1
        copies = dict(rest)
        copies[longest] = copies.get(longest, 0) + 1
        bins = min(left[x] // c for x, c in copies.items())
        for x, c in copies.items():
            left[x] -= c * bins
            if not left[x]:
                del left[x]
        plan.append((sorted(copies.items(), reverse=True), bins))
    return plan


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``_id, piece, start, length, ids, _task, _number``: each text's ids and ``end_id``, cut into pieces of ``capacity`` of which the first may be shorter.

    ``ids`` are little-endian unsigned 32-bit ids.  ``_number`` counts the pieces of one
    length in one task from 0.
    """
    classes = compile_tokenizer(tokenizer)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kinds = {"_id": rows.schema["_id"].dataType, "piece": T.IntegerType(), "start": T.LongType(), "length": T.IntegerType(), "ids": T.BinaryType(), "_task": T.IntegerType(), "_number": T.LongType()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, task, seen = transducer(tokenizer, classes), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
        for batch in batches:
            at, out, size = [], [], 0

            def flush() -> pa.RecordBatch:
                columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(types)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=list(kinds))

            for row, ids in enumerate(machine.token_ids(batch.column(1).to_pylist())):
                ids = np.append(ids, end_id).astype("<u4")
                first = len(ids) % capacity or capacity
                for piece, start in enumerate((0, *range(first, len(ids), capacity))):
                    part = ids[start : start + capacity] if piece else ids[:first]
                    at.append(row)
                    out.append((piece, start, len(part), part.tobytes(), task, int(seen[len(part)])))
                    seen[len(part)] += 1
                    size += 4 * len(part)
                    if size >= OUT_BYTES:
                        yield flush()
                        at, out, size = [], [], 0
            if out:
                yield flush()

    return rows.mapInArrow(cut, T.StructType([T.StructField(k, v) for k, v in kinds.items()]))


def min_slack_places(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with ``length, _task, _number``) with ``sequence_id, offset``.

    The driver gets one number a length.  The table of (task, length) is broadcast up to
    ``tables.SMALL`` rows and else joined by its key, which no task has often.
    """
    spark = pieces.sparkSession
    counts = written(pieces.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_count")))
    plan = min_slack_plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_count").alias("n")).collect()}, capacity)
    spans: dict[int, list[tuple[int, int, int, int, int]]] = {}
    sequence = 0
    for pattern, bins in plan:
        offset = 0
        for length, copies in pattern:
            before = spans.setdefault(length, [])
            low = before[-1][1] if before else 0
            before.append((low, low + copies * bins, copies, sequence, offset))
            offset += length * copies
        sequence += bins
    planned = spark.createDataFrame(list(spans.items()), "length int, _spans array<struct<low: long, high: long, copies: long, sequence: long, offset: long>>")
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_count").over(earlier), F.lit(0))
    placed = counts.withColumn("_first", first).join(F.broadcast(planned), "length")
    span = F.explode(F.filter("_spans", lambda s: (s["low"] < F.col("_first") + F.col("_count")) & (s["high"] > F.col("_first"))))
    ranges = written(placed.select("length", "_task", "_first", span.alias("_span")))
    number = F.col("_first") + F.col("_number")
    out = pieces.join(small(ranges), ["length", "_task"]).filter((number >= F.col("_span.low")) & (number < F.col("_span.high")))
    inside = number - F.col("_span.low")
    copies = F.col("_span.copies")
    offset = F.col("_span.offset") + inside % copies * F.col("length")
    return out.select(*pieces.columns, (F.col("_span.sequence") + F.floor(inside / copies)).alias("sequence_id"), offset.alias("offset"))


def pack_min_slack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset`` for every piece of every text.

    A document is its text's token ids (as the tokenizer's library gives them, without added
    tokens) and ``end_id``; only one longer than ``capacity`` is cut, and only its first
    piece may be shorter than that.  The pieces of a sequence lie side by side from offset 0
    and fill at most ``capacity``.  Null and empty texts are ``end_id`` alone.  Repeated rows
    and null ids are packed like any row; ids may be of any type; other columns are not read;
    an empty table gives no rows.  The pieces are written once in the shared folder, so what
    was placed stays placed when executors are lost; another split of the input may give
    other sequences of the same number.
    """
    pieces = written(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col))
    out = min_slack_places(pieces, capacity)
    return out.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """One row a sequence: ``sequence_id, n_tokens, ids`` with the ids of its pieces side by side."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("_parts"))
    length = F.aggregate("_parts", F.lit(0).cast("long"), lambda total, x: total + x["length"])
    ids = F.aggregate("_parts", F.lit(b""), lambda before, x: F.concat(before, x["ids"]))
    return grouped.select("sequence_id", length.alias("n_tokens"), ids.alias("ids"))

"""Intermediate tables and joins that hold at any size."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a side of a join may have to be broadcast.
SMALL = 1_000_000
#: Rows of one key that are paired at a time.
PAIR_BLOCK = 1024
#: Rows of one key that meet at a time where pairs are tested.  A row travels once for each such block of its key.
MEET_BLOCK = 16_384
#: Rows of a key or less whose pairs are made together with those of other keys.
FEW_ROWS = 100
#: Rows that are gathered before they go back to Spark.
SENT_ROWS = 1 << 15
#: Bytes of text that go through Python, and back to Spark, together; a longer text goes alone.
PIECE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share; only in local mode may it be unset, for a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sentryloom-"))
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """The rows, written once as Parquet in the shared folder and read from there; removed when the JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """Marked for broadcast if it has at most so many rows; give it a table that is cheap to read."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def pieces(batch: pa.RecordBatch, at: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes (``PIECE_BYTES``) of its column ``at``, a text or binary column, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (most or PIECE_BYTES), "right")))
        yield batch.slice(low, high - low)
        low = high


class Nearest(NamedTuple):
    """Items of ``signed`` rows, to be paired as ``overlaps`` does with ``nearest``."""

    most: int
    block: int


def pairs_by_key(df: DataFrame, keys: list[str], item: str | Nearest, block: int = PAIR_BLOCK) -> DataFrame:
    """Rows ``a, b, *keys`` with a < b for items that share a key, each row of ``df`` one (key, item).

    A key of many items is cut into blocks by a hash of the item, and blocks meet in pairs,
    so no task pairs more than about ``block`` squared rows at a time.  Given ``Nearest``, rows
    are ``signed`` and only the pairs of ``overlaps`` come, without the keys.
    """
    if isinstance(item, Nearest):
        return overlaps(df, several=True, nearest=item.most, block=item.block)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    sized = df.join(sizes, keys).withColumn("_nb", F.ceil(F.col("_c") / block)).withColumn("_own", F.pmod(F.xxhash64(item), F.col("_nb")))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1))
    a = sized.select(*keys, F.col(item).alias("a"), F.col("_own").alias("_i"), others.alias("_j"))
    b = sized.select(*keys, F.col(item).alias("b"), F.col("_own").alias("_j"), others.alias("_i"))
    return a.join(b, [*keys, "_i", "_j"]).filter("a < b").select("a", "b", *keys)


#: A column of one of two rows that meet, by name.
Side = Callable[[str], Column]


def sides() -> tuple[Side, Side]:
    return lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}")


def meet(df: DataFrame, keys: list[str], columns: list[str], passes: Callable[[Side, Side], Column], block: int = MEET_BLOCK) -> DataFrame:
    """The keys and ``a_<column>``, ``b_<column>`` of each two rows that share the keys and pass, once and in no order.

    ``passes`` is asked inside the join, so only pairs that pass leave it.  The rows of one key are
    cut into blocks by a hash of the column ``key``, which differs within a key, and two
    blocks meet once, so a hot key is spread over tasks.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    sized = df.join(sizes, keys).withColumn("_nb", F.ceil(F.col("_c") / block)).withColumn("_own", F.pmod(F.xxhash64("key"), F.col("_nb")))
    side = lambda n: [F.col(c).alias(f"{n}_{c}") for c in columns]
    a = sized.select(*keys, F.col("_own").alias("_i"), F.explode(F.sequence("_own", F.col("_nb") - 1)).alias("_j"), *side("a"))
    b = sized.select(*keys, F.col("_own").alias("_j"), F.explode(F.sequence(F.lit(0).cast("long"), "_own")).alias("_i"), *side("b"))
    once = (F.col("_i") < F.col("_j")) | (F.col("a_key") < F.col("b_key"))
    # Work goes with the square of a partition, so they are not put together by their bytes.
    a, b = (x.repartition(_partitions(df), *keys, "_i", "_j") for x in (a, b))
    return a.join(b, [*keys, "_i", "_j"]).filter(once & passes(*sides()))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Pairing(NamedTuple):
    """What pairs of rows make.

    ``blocks`` gets the rows of two blocks of a key, or those of one block twice (the same object).  ``few``,
    if there is one, gets rows of many keys of few rows each, and the places of both rows of each pair.
    """

    blocks: Callable[[pa.RecordBatch, pa.RecordBatch], Iterator[pa.RecordBatch]]
    few: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]] | None = None


def _partners(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of both rows of each pair in the ranges."""
    sizes = ends - begins
    row = np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
    counts = np.repeat(ends, sizes) - row - 1
    left = np.repeat(row, counts)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts) + left + 1


def met_in_blocks(df: DataFrame, keys: list[str], columns: list[str], pairing: Pairing, schema: T.StructType, block: int = MEET_BLOCK) -> DataFrame:
    """``meet`` in Arrow: the rows that a ``Pairing`` makes of the pairs of each key.

    Rows are dealt by (keys, blocks) and sorted, so a task holds two blocks at a time.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    sized = df.join(sizes, keys).withColumn("_nb", F.ceil(F.col("_c") / block)).withColumn("_own", F.pmod(F.xxhash64("key"), F.col("_nb")))
    other = sized.select(*keys, *[c for c in columns if c not in keys], "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)).alias("_t"))
    at = [*keys, "_i", "_j"]
    dealt = other.select(*columns, *[k for k in keys if k not in columns], F.least("_own", "_t").alias("_i"), F.greatest("_own", "_t").alias("_j"), (F.col("_own") > F.col("_t")).alias("_second"))
    # Work goes with the square of a partition, so they are not put together by their bytes.
    dealt = dealt.repartition(_partitions(df), *at).sortWithinPartitions(*at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            new = np.zeros(batch.num_rows, bool)
            for c in at:
                values = batch.column(c)
                new[1:] |= pc.not_equal(values.slice(1), values.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.append(True, new[1:])) if batch.num_rows else np.zeros(0, np.int64)
            ends = np.append(begins[1:], batch.num_rows)
            if pairing.few and len(begins) > 2:
                one = batch.column("_i").to_numpy()[begins] == batch.column("_j").to_numpy()[begins]
                few = one & (ends - begins <= FEW_ROWS)
                few[[0, -1]] = False  # they may go on in another batch
                yield from pairing.few(batch, *_partners(begins[few], ends[few]))
                begins, ends = begins[~few], ends[~few]
            for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
                part = batch.slice(begin, end - begin)
                if held and any(held[0].column(c)[0] != part.column(c)[0] for c in at):
                    yield from of_group(held)
                    held = []
                held.append(part)
        if held:
            yield from of_group(held)

    def of_group(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]
        if rows.column("_i")[0] == rows.column("_j")[0]:
            yield from pairing.blocks(rows, rows) if rows.num_rows > 1 else ()
        else:
            second = rows.column("_second")
            yield from pairing.blocks(rows.filter(pc.invert(second)), rows.filter(second))

    return dealt.mapInArrow(lambda batches: gathered(run(batches)), schema)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``SENT_ROWS`` or more, as each costs more than its rows if they are few."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= SENT_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def components(links: DataFrame) -> DataFrame:
    """``_node, _label`` (the smallest node reachable) for the nodes of ``_a, _b`` links.

    Labels take the minimum over neighbours and then jump to the label of their label, so
    the rounds grow with the logarithm of a component's diameter.  Each round is written
    to the shared folder; only whether a label changed comes to the driver.
    """
    edges = written(links.select("_a", "_b").union(links.select("_b", "_a")).distinct())
    labels = written(edges.groupBy("_a").agg(F.min("_b").alias("_m")).select(F.col("_a").alias("_node"), F.least("_a", "_m").alias("_label"), F.lit(True).alias("_new")))
    while labels.filter("_new").limit(1).count():
        near = edges.join(labels.select(F.col("_node").alias("_b"), "_label"), "_b").groupBy("_a").agg(F.min("_label").alias("_m"))
        low = labels.join(near.withColumnRenamed("_a", "_node"), "_node").select("_node", "_label", F.least("_label", "_m").alias("_low"))
        jump = low.select(F.col("_node").alias("_low"), F.col("_low").alias("_next"))
        labels = written(low.join(jump, "_low", "left").select("_node", F.coalesce("_next", "_low").alias("_to"), "_label").select("_node", F.col("_to").alias("_label"), (F.col("_to") < F.col("_label")).alias("_new")))
    return labels.select("_node", "_label")


#: Longs of 64 bits of a signature.
SIGNATURE = tuple(f"_s{w}" for w in range(4))


def signed(mentions: DataFrame, item: str, key: str) -> DataFrame:
    """The distinct ``x, i`` (item and key, none null), each with a signature of the other keys of the item.

    Two items that share a key besides ``i`` have a bit in common in their signatures at ``i``; if
    they have none, ``i`` is all that they share.  A key's bit is left out at the key itself where all
    keys of the item have bits of their own; else it stays, as another key may have set it too.
    """
    at = F.pmod(F.xxhash64("i"), F.lit(64 * len(SIGNATURE)))
    m = mentions.select(F.col(item).alias("x"), F.col(key).alias("i")).filter("x IS NOT NULL AND i IS NOT NULL")
    m = m.repartition("x").distinct().withColumn("_at", at.cast("int"))
    own = {s: F.when(F.shiftright("_at", 6) == w, F.expr("shiftleft(1L, _at & 63)")).otherwise(F.lit(0).cast("long")) for w, s in enumerate(SIGNATURE)}
    every = Window.partitionBy("x")
    m = m.select("x", "i", *[own[s].alias(f"{s}_own") for s in SIGNATURE])
    m = m.select("*", *[F.bit_or(f"{s}_own").over(every).alias(s) for s in SIGNATURE], F.count(F.lit(1)).over(every).alias("_n"))
    apart = sum((F.bit_count(s) for s in SIGNATURE[1:]), F.bit_count(SIGNATURE[0])) == F.col("_n")
    return m.select("x", "i", *[F.when(apart, F.col(s).bitwiseXOR(F.col(f"{s}_own"))).otherwise(F.col(s)).alias(s) for s in SIGNATURE])


def overlaps(rows: DataFrame, several: bool, nearest: int | None = None, block: int = PAIR_BLOCK) -> DataFrame:
    """Pairs ``a, b`` of items of ``signed`` rows that share a key, made key by key in Arrow.

    With ``several`` those that may share more keys, a < b, once for each common key; else those
    that share one key alone, a < b, so each is there once and nothing is left to add up.  With
    ``nearest`` each comes both ways, and both kinds do, but of those that share one key
    alone only so many with the smallest b for each a and key; no key may then have more
    than ``block`` rows.  A key of more rows is cut into blocks by a hash of the item.
    """
    if nearest is None:
        sizes = rows.groupBy("i").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > block)
        sized = rows.join(small(written(sizes.select("i", F.ceil(F.col("_c") / block).alias("_nb")))), "i", "left").withColumn("_nb", F.coalesce("_nb", F.lit(1).cast("long")))
        sized = sized.withColumn("_own", F.pmod(F.xxhash64("x"), F.col("_nb"))).withColumn("_t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)))
        dealt = sized.select("x", "i", *SIGNATURE, F.least("_own", "_t").cast("int").alias("_i"), F.greatest("_own", "_t").cast("int").alias("_j"), (F.col("_own") > F.col("_t")).alias("_second"))
        at = ["i", "_i", "_j"]
    else:
        dealt, at = rows.select("x", "i", *SIGNATURE), ["i"]
    order = [*at, "_second", "x"] if nearest is None else [*at, "x"]
    dealt = dealt.repartition(*at).sortWithinPartitions(*order)
    schema = T.StructType([T.StructField(c, rows.schema["x"].dataType) for c in ("a", "b")])
    most = 1 << 20

    def of_groups(part: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n, x = part.num_rows, part.column("x")
        ends = np.append(starts[1:], n)
        sizes = ends - starts
        row, first, last = np.arange(n), np.repeat(starts, sizes), np.repeat(ends, sizes)
        if nearest is None:
            second = part.column("_second").to_numpy(zero_copy_only=False)
            begin = np.repeat(ends - np.add.reduceat(second.astype(np.int64), starts), sizes)  # of the second block
            crossed = part.column("_i").to_numpy() != part.column("_j").to_numpy()
            first = np.where(crossed, np.where(second, last, begin), row + 1)
        signs = np.stack([part.column(s).to_numpy() for s in SIGNATURE])
        partners = np.cumsum(last - first)
        low = 0
        while low < n:
            done = partners[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(partners, done + most, "right")))
            counts = (last - first)[low:high]
            left = np.repeat(row[low:high], counts)
            right = np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[low:high], counts)
            more = (signs[0][left] & signs[0][right]) != 0
            for s in signs[1:]:
                more |= (s[left] & s[right]) != 0
            if nearest is None:
                keep = more if several else ~more
            else:
                other = left != right
                alone = other & ~more
                rank = np.cumsum(alone)
                before = np.concatenate([[0], rank])[np.cumsum(counts) - counts]
                keep = (other & more) | (alone & (rank - np.repeat(before, counts) <= nearest))
            a, b = x.take(pa.array(left[keep])), x.take(pa.array(right[keep]))
            if nearest is None:
                less = pc.less(a, b)
                a, b = pc.if_else(less, a, b), pc.if_else(less, b, a)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None

        def starts_of(part: pa.RecordBatch) -> np.ndarray:
            new = np.zeros(part.num_rows, bool)
            new[:1] = True
            for c in at:
                values = part.column(c)
                new[1:] |= pc.not_equal(values.slice(1), values.slice(0, part.num_rows - 1)).to_numpy(zero_copy_only=False)
            return np.flatnonzero(new)

        for batch in batches:
            part = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if part.num_rows:
                starts = starts_of(part)
                if starts[-1]:
                    yield from of_groups(part.slice(0, starts[-1]), starts[:-1])
                held = part.slice(starts[-1])
        if held is not None:
            yield from of_groups(held, starts_of(held))

    return dealt.mapInArrow(run, schema)

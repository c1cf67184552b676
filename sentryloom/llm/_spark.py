"""Spark helpers of the corpus operators: tables, shared checkpoints, skew-safe joins and ranks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import pieces, shared_dir, small, written

__all__ = ["BLANK", "TIES", "WORD", "append_columns", "join_groups", "n_buckets", "named_apart", "pieces", "prefix_sums", "renamed_apart", "shared_dir", "small", "table", "with_row_order", "written"]

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A group is hot from this many rows, or from a millionth of all rows if that is more, so at most a million rows of hot groups are broadcast.
HOT_ROWS = 10_000
#: Rows that one task orders at a time when ranks and prefix sums are made.
BUCKET_ROWS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def renamed_apart(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns of the input whose names an operator gives to its own output go first out of the way."""
    return df.drop(*[c for c in df.columns if c in names])


def named_apart(df: DataFrame, internal: Sequence[str], *columns: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], list[str]]:
    """The table with columns named like an operator's internal ones renamed, a function that names them back, and the names that ``columns`` have now."""
    taken = {c.lower() for c in df.columns} | {c.lower() for c in internal}
    new: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in {x.lower() for x in internal}:
            name = f"{c}_of_input"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            new[c] = name
    lower = {k.lower(): v for k, v in new.items()}
    return df.withColumnsRenamed(new), lambda out: out.withColumnsRenamed({v: k for k, v in new.items()}), [lower.get(c.lower(), c) for c in columns]


def append_columns(df: DataFrame, column: str, fields: list[T.StructField], start: Callable[[], Callable[[list], list[pa.Array]]]) -> DataFrame:
    """All columns of ``df`` and the new ``fields``, computed from ``column`` in Arrow batches.

    ``start`` is called once a task and gives a function from a batch of values to the new
    arrays.  Other columns pass through as Arrow arrays, so no value of them can change.
    A batch goes through in ``pieces``, so a worker holds one piece as Python objects.
    """
    at = [c.lower() for c in df.columns].index(column.lower())
    names = [*df.columns, *[f.name for f in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = start()
        for batch in batches:
            for part in pieces(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, *made(part.column(at).to_pylist())], names=names)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


#: Names of the columns that ``with_row_order`` adds.
TIES = ["_tie1", "_tie2"]


def with_row_order(df: DataFrame) -> DataFrame:
    """``df`` with ``TIES``, 128 bits of hash over all columns (maps and variants as JSON): only rows alike in every column tie on them.

    They are made where rows are read, so an order by them moves no text.
    """
    plain = [F.to_json(F.struct(F.col(c))) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in df.dtypes]
    return df.withColumns({name: F.xxhash64(F.lit(i), *[F.isnull(c) for c in plain], *plain) for i, name in enumerate(TIES)})


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, spread: Column) -> DataFrame:
    """Left join of rows with one row per group, where a few groups may hold most rows.

    Hot groups are broadcast; their rows take part in the shuffled join under a spread key
    that matches nothing, so no task gets a hot group.
    """
    values = [c for c in groups.columns if c not in keys]
    packed = groups.select(*keys, F.struct(*values).alias("_v"))
    hot = groups.filter(F.col(size) >= max(HOT_ROWS, total // 1_000_000)).select(*keys, F.struct(*values).alias("_hot"))
    cold = packed.withColumn("_spread", F.lit(0).cast("long"))
    out = rows.join(F.broadcast(hot), keys, "left")
    out = out.withColumn("_spread", F.when(F.col("_hot").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(spread).bitwiseOR(F.lit(1).cast("long"))))
    out = out.join(cold, [*keys, "_spread"], "left").withColumn("_v", F.coalesce("_hot", "_v"))
    return out.select(*rows.columns, *[F.col(f"_v.{c}").alias(c) for c in values])


def n_buckets(total: int, rows: int = BUCKET_ROWS) -> int:
    return max(1, -(-total // rows))


def prefix_sums(df: DataFrame, group: list[str], key: str, ties: Sequence[str], amount: Column, buckets: int, out: str, extra: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """For each row the sum of ``amount`` over the rows before it in its group, by hash key.

    The hash keys of a group are cut into ``buckets`` equal ranges; the order is that of the
    unsigned keys, then ties.  Sums of (group, bucket) are made with map-side combining,
    written, and turned into offsets; rows are ordered only inside one (group, bucket), so
    the largest sort is bounded by the bucket size and not by the group.  ``extra`` makes
    from those sums a table with values for each group; they come along with the offsets.
    """
    low = F.lit(-(1 << 63)).cast("long")
    place = F.shiftright(F.shiftrightunsigned(F.col(key), 33) * F.lit(buckets).cast("long"), 31)
    df = df.withColumn("_b", place.cast("int")).withColumn("_x", amount.cast("long"))
    sums = written(df.groupBy(*group, "_b").agg(F.sum("_x").alias("_sum")))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    if extra is not None:
        offsets = offsets.join(extra(sums), group)
    inside = Window.partitionBy(*group, "_b").orderBy(F.col(key).bitwiseXOR(low), *ties).rowsBetween(Window.unboundedPreceding, -1)
    df = df.join(small(written(offsets)), [*group, "_b"]).withColumn(out, F.col("_offset") + F.coalesce(F.sum("_x").over(inside), F.lit(0)))
    return df.drop("_b", "_x", "_offset")

"""Mixing sources to target weights by distributed prefix sums over hash-random keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import BUCKET_ROWS, TIES, WORD, n_buckets, named_apart, prefix_sums, renamed_apart, with_row_order

OUTPUTS = ["size", "source_size", "target", "taken"]
INTERNAL = ["_null", "_src", "_k", "_b", "_x", "_offset", "_before", *TIES]


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """One row per source with ``source_size`` to ``target``.

    Sources in code point order (null last) take the weights in turn and share
    ``share`` of all words; no target exceeds ``cap`` times its source, and what is over is
    shared again by weight.  The fixed point of that resharing is ``min(cap*size, w*x)``
    for the one x at which the targets add up, which a running sum over the sources by
    ``cap*size/w`` finds.  That table has one row per source and is ordered in one task, so
    sources are taken to be far fewer than documents.
    """
    by_name = Window.orderBy("_null", "_src")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    s = s.withColumn("_rho", F.col("_cap") / F.col("_w"))
    upto = Window.orderBy("_rho", "_null", "_src").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.orderBy("_rho", "_null", "_src").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("_full", F.sum("_cap").over(upto) + F.col("_rho") * F.coalesce(F.sum("_w").over(after), F.lit(0.0)) <= F.col("_all"))
    held = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0.0))
    open_w = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything)
    s = s.withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.least("_cap", F.col("_w") * ((F.col("_all") - held) / open_w))))
    return s.select("_null", "_src", "source_size", "target")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 23, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` with ``size, source_size, target, taken``.

    ``taken`` counts the words that the mix takes from the row: whole epochs of the source
    first, then rows in the order of a hash of the id until the source's budget (its target,
    rounded) is met exactly, the last row in part.  The same rows and seed give the same
    mix.  Null text has no words and takes none; a null source is a source of its own; a
    null id is hashed like any value; repeated rows count each, and rows alike in id are
    ordered by a hash of all their columns; an empty table gives an
    empty result; input columns named like the outputs are replaced.
    """
    docs, names_back, (id_col, text_col, source_col) = named_apart(renamed_apart(docs, OUTPUTS), INTERNAL, id_col, text_col, source_col)
    rows = with_row_order(docs).withColumns({"size": word_count(F.col(text_col)), "_null": F.col(source_col).isNull(), "_src": F.coalesce(F.col(source_col), F.lit("")), "_k": F.xxhash64(F.lit(seed), id_col)})
    total = docs.count()
    key = ["_null", "_src"]

    def targets(sums: DataFrame) -> DataFrame:
        return source_targets(sums.groupBy(*key).agg(F.sum("_sum").alias("source_size")), weights, share, cap)

    ties = [id_col, *TIES]
    rows = prefix_sums(rows, key, "_k", ties, F.col("size"), n_buckets(total, bucket_rows), "_before", targets)
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    taken = F.col("size") * epochs + F.greatest(F.lit(0), F.least("size", rest - F.col("_before")))
    return rows.withColumn("taken", taken.cast("long")).transform(lambda out: names_back(out.select(*docs.columns, *OUTPUTS)))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``.

    A row appears once for each time that the mix takes it; a row that the mix takes in part
    at the cut appears if at least half of it is taken, so each source's words come within
    one document of its target.  Rows without words take no part and stay out.
    """
    docs, names_back, _ = named_apart(docs, [*OUTPUTS, "_times", "_copy"])
    mixed = mix_sources(docs, **options)
    times = F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int")
    mixed = mixed.filter(F.col("size") > 0).withColumn("_times", times).filter("_times > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).transform(lambda out: names_back(out.select(*docs.columns)))

"""Exact deduplication by progressive refinement, in DataFrame operations only.

Rows are grouped by the length of the normalised text, groups of more than one row by the
hash of a short prefix, and only rows of groups that survive both are hashed in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import BLANK, join_groups, named_apart, renamed_apart, small, written

#: Characters of the prefix that the second level hashes.
PREFIX_CHARS = 64
#: Up to so many surviving groups (16 bytes each) are broadcast to the scan, and then no text moves; beyond, rows meet them in a shuffle.
BROADCAST_GROUPS = 1_000_000
INTERNAL = ["_n", "_p", "_h", "_v", "_hot", "_spread", "_row"]


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``keep_id, group_size, kept``.

    Equal texts after normalisation form a group; ``keep_id`` is its smallest id.  Null
    text is the empty text, so null and empty texts form one group.  A null id never
    stays if the group has another; of a group of null ids one row stays (``keep_id`` null).
    Repeated rows with one id count in ``group_size`` and all carry the same ``kept``.  An
    empty table gives an empty result; input columns named like the outputs are replaced.
    Texts are hashed in full only in groups that survive, at every size.  While the surviving
    groups can be broadcast no text is shuffled unless the caller selects it from the result.
    """
    docs, names_back, (id_col, text_col) = named_apart(renamed_apart(docs, ["keep_id", "group_size", "kept"]), INTERNAL, id_col, text_col)
    norm = normalised(F.col(text_col))
    rows = docs.withColumns({"_n": F.octet_length(norm), "_p": F.xxhash64(F.substring(norm, 1, PREFIX_CHARS))})
    pairs = written(rows.groupBy("_n", "_p").agg(F.count(F.lit(1)).alias("_c")))
    total = pairs.agg(F.sum("_c")).first()[0] or 0
    lengths = pairs.groupBy("_n").agg(F.sum("_c").alias("_all")).filter("_all > 1").select("_n")
    side = small(written(pairs.filter("_c > 1").join(lengths, "_n", "left_semi").select("_n", "_p")), BROADCAST_GROUPS)
    alive = rows.join(side, ["_n", "_p"], "left_semi").withColumn("_h", F.sha2(norm, 256))
    single = rows.join(side, ["_n", "_p"], "left_anti").select(*docs.columns, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    groups = written(alive.groupBy("_n", "_p", "_h").agg(F.min(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    joined = join_groups(alive, groups, ["_n", "_p", "_h"], "group_size", total, F.col(id_col)).select(*docs.columns, "keep_id", "group_size")
    kept = F.col(id_col).eqNullSafe(F.col("keep_id"))
    if groups.filter("keep_id IS NULL AND group_size > 1").limit(1).count():
        joined, nameless = joined.filter("keep_id IS NOT NULL OR group_size = 1"), joined.filter("keep_id IS NULL AND group_size > 1")
        rows = written(nameless.withColumns({"_h": F.sha2(norm, 256), "_row": F.monotonically_increasing_id()}))
        stays = rows.groupBy("_h").agg(F.min("_row").alias("_row")).withColumn("kept", F.lit(True))
        rows = rows.join(small(stays), ["_h", "_row"], "left").withColumn("kept", F.coalesce("kept", F.lit(False))).drop("_h", "_row")
        return names_back(joined.unionByName(single).withColumn("kept", kept).unionByName(rows))
    return names_back(joined.unionByName(single).withColumn("kept", kept))

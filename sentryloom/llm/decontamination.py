"""Benchmark decontamination: short test items found inside documents of any length.

Containment search with one-sided MinHash: only the items are sketched.  Items fall into
size classes by powers of two of their shingle set; the index keeps a class's smallest need
with its smallest hashes, and a document with fewer shingles than the class needs is not
probed there.  The number of hits asked for is what containment implies at the item's size
(exactly where a sketch holds the whole set, up to chance elsewhere).  A document's shingles
are probed against the inverted sketches, so the sizes of documents do not weaken the estimate as they would in
two-sided sketches.  Candidates are verified by the exact containment of the full sets.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import BLANK, written

SHINGLE = 5
SKETCH = 64
LEAST = (75, 100)
SIGMAS = 5.0
#: Sketch rows (32 bytes) and candidate ids (8 bytes) are broadcast up to these many; beyond, the join is shuffled.
BROADCAST_SKETCH, BROADCAST_IDS = 1_000_000, 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_hashes(text: Column) -> Column:
    """Hashes of the 5-word shingles of a text, in order; fewer words make one; no words none."""
    blanks = F.lit(" \t\n\x0b\f\r")
    words = F.split(F.btrim(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), blanks), BLANK)

    def cut(w: Column) -> Column:
        by_five = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        short = F.when(F.get(w, F.lit(0)) == "", F.array().cast("array<long>")).otherwise(F.array(F.xxhash64(F.array_join(w, " "), F.lit("short"))))
        return F.when(F.size(w) >= SHINGLE, by_five).otherwise(short)

    return F.flatten(F.transform(F.array(words), cut))  # the words are bound to a variable, so they are split once


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has at most so many rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", sketch_size: int | None = SKETCH) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment``: pairs in which the document holds at least 75 % of the item's distinct shingles.

    ``sketch_size`` hashes are kept of an item, and a pair at the threshold is missed only by a
    chance of 5 standard deviations of its sample; None keeps all, so nothing is missed.
    Items without words are found nowhere; an item of fewer words than a shingle is found in
    documents that are those words.  Null, empty and blank documents hold nothing.  Rows
    with a null document or item id are not reported; rows that repeat an id count as one
    document (or item) of all their shingles, and each pair is reported once.  Texts of
    any length are searched whole.  Empty tables give no pairs.
    """
    shingled = items.filter(F.col(item_col).isNotNull()).select(F.col(item_col).alias("_item"), F.explode(shingle_hashes(F.col(item_text_col))).alias("_h")).distinct()
    sizes = shingled.groupBy("_item").agg(F.count(F.lit(1)).alias("_m"))
    full = written(shingled.join(sizes, "_item").withColumn("_class", F.floor(F.log2("_m")).cast("int")))
    nth = F.row_number().over(Window.partitionBy("_item").orderBy(F.shiftrightunsigned("_h", 1), "_h"))
    need = F.floor((F.col("_m") * LEAST[0] + LEAST[1] - 1) / LEAST[1])
    smallest = F.floor((F.pow(F.lit(2), F.col("_class")) * LEAST[0] + LEAST[1] - 1) / LEAST[1]).cast("long")  # shingles that any item of the class needs
    size = F.lit(sketch_size) if sketch_size else F.col("_m")
    share = LEAST[0] / LEAST[1]
    hits = F.when(F.col("_m") <= size, need).otherwise(F.floor(size * share - SIGMAS * F.sqrt(size * (share * (1 - share)))))
    sketch = full.withColumn("_nth", nth).filter(F.col("_nth") <= size).select("_class", "_h", "_item", smallest.alias("_smallest"), need.alias("_need"), hits.cast("long").alias("_hits"))
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_doc"), shingle_hashes(F.col(text_col)).alias("_s"))
    probes = texts.select("_doc", F.size("_s").alias("_n"), F.explode("_s").alias("_h"))
    # Rows of one id are one document, so sizes are only a filter where ids do not repeat.
    single = not docs.groupBy(id_col).count().filter("count > 1").limit(1).count()
    fits = (F.col("_n") >= F.col("_smallest")) if single else F.lit(True)
    found = probes.join(_small(sketch, BROADCAST_SKETCH), "_h").filter(fits)
    seen = found.groupBy("_doc", "_item", "_h").agg(F.max("_hits").alias("_hits"))
    candidates = seen.groupBy("_doc", "_item").agg(F.count(F.lit(1)).alias("_got"), F.max("_hits").alias("_hits"))
    candidates = written(candidates.filter("_got >= _hits").select("_doc", "_item"))
    chosen = docs.join(_small(candidates.select(F.col("_doc").alias(id_col)).distinct(), BROADCAST_IDS), id_col, "left_semi")
    held = chosen.select(F.col(id_col).alias("_doc"), F.explode(F.array_distinct(shingle_hashes(F.col(text_col)))).alias("_h")).join(_small(full, BROADCAST_SKETCH), "_h")
    exact = held.join(candidates, ["_doc", "_item"]).groupBy("_doc", "_item", "_m").agg(F.count_distinct("_h").alias("n_shared"))
    exact = exact.filter(F.col("n_shared") * LEAST[1] >= F.col("_m") * LEAST[0])
    return exact.select(F.col("_doc").alias(id_col), F.col("_item").alias(item_col), F.col("_m").alias("n_item"), "n_shared", (F.col("n_shared") / F.col("_m")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item; rows with a null id stay."""
    held = written(contained_items(docs, items, id_col, text_col, item_col, item_text_col).select(id_col).distinct())
    return docs.join(_small(held, BROADCAST_IDS), id_col, "left_anti").select(*docs.columns)

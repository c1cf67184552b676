"""Near-duplicate groups by bottom-k sketches, with every link confirmed on full shingle sets.

1. Texts with the same shingle set form a class; only one row of each class goes on.
2. The k smallest hashes of a set (one hash function) are its sketch.  Inverted lists of
   the retained values give candidates.  A pair at the threshold shares at least ``o`` of
   its retained values, but for a chance below 1e-6, so of each sketch only the
   ``k - o + 1`` values that the fewest sketches hold need a list: common passages drop out.
   A set that its sketch holds whole counts what a partner's cut sketch may leave out.
3. Short lists give all their pairs.  Members of long lists get lists again from their
   full sets, where ``o`` is exact: a prefix of the rarest shingles of each set.  Lists
   that stay long (large groups of near copies) are not expanded: their most central
   member is compared with the others, and later only members of different components
   are compared, so no link between components is lost and no group makes all its pairs.
4. Pairs pass by the Jaccard estimate of their union sketch, then by the exact Jaccard
   similarity of the full sets.  Components of the links give the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import components
from ._spark import join_groups, written
from ._words import shingle_sets

K = 64
#: Lists up to this long give all their pairs.
SHORT_LIST = 32
#: Similarity as a fraction, so that the test is exact in integers.
LEAST = (75, 100)
#: Standard deviations that an estimate may lie below the threshold.
SIGMAS = 5.0
#: Values held by three or more sketches are broadcast up to this many (8 bytes each).
BROADCAST_VALUES = 500_000
#: Rounds in which long lists are compared with one central member each.
PIVOT_ROUNDS = 3


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``_id, _n, _fp`` (a 128-bit name of the shingle set) and ``_sketch``, per row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(s), blake2b(s.tobytes(), digest_size=16).digest(), (s[:k] >> np.uint64(1)).astype(np.int64)) for s in shingle_sets(batch.column(1).to_pylist())]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["_id", "_n", "_fp", "_sketch"])

    id_type = docs.select(id_col).dtypes[0][1]
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(sketch, f"_id {id_type}, _n long, _fp binary, _sketch array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_node, _n, _set`` of the wanted classes, from the texts of their representatives."""

    def full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = list(shingle_sets(batch["_text"].tolist()))
            yield pd.DataFrame({"_fp": [blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "_set": [(s >> np.uint64(1)).astype(np.int64) for s in sets]})

    texts = docs.select(F.col(id_col).alias("_rep"), F.col(text_col).alias("_text")).join(wanted.select("_rep").distinct(), "_rep", "left_semi")
    sets = texts.select("_text").mapInPandas(full, "_fp binary, _set array<long>")
    return wanted.join(sets, "_fp").groupBy("_node").agg(F.first("_n").alias("_n"), F.first("_set").alias("_set"))


def _cut_partner_overlap(n: int, k: int) -> int:
    """How many values a whole sketch of n at most k shingles shares at least, up to chance, with the sketch of a linked set of more than k.

    The k values that the larger set keeps are a random sample of its m, of which at least
    the overlap that the sizes ask for lie in the smaller set.
    """
    chance = math.erfc(SIGMAS / math.sqrt(2)) / 2
    both, least = LEAST[0] + LEAST[1], n
    for m in range(k + 1, n * LEAST[1] // LEAST[0] + 1):
        shared = -(-(n + m) * LEAST[0] // both)
        below, got = 0.0, max(0, k - (m - shared))
        while got < least and (below := below + math.comb(shared, got) * math.comb(m - shared, k - got) / math.comb(m, k)) <= chance:
            got += 1
        least = got
    return least


def _overlap(size: Column, k: int | None) -> Column:
    """How many retained values a pair at the threshold shares at least: exactly, or, where a sketch of the pair may be cut, up to chance."""
    share = LEAST[0] / LEAST[1]
    exact = F.floor((size * LEAST[0] + LEAST[1] - 1) / LEAST[1])
    if k is None:
        return exact
    out = F.when(F.col("_n") * LEAST[1] < (k + 1) * LEAST[0], exact)
    for n in range(-(-(k + 1) * LEAST[0] // LEAST[1]), k + 1):
        out = out.when(F.col("_n") == n, F.least(exact, F.lit(_cut_partner_overlap(n, k))))
    return out.otherwise(F.floor(size * share - F.sqrt(size * (share * (1 - share))) * SIGMAS))


def _prefix_lists(values: DataFrame, nodes: DataFrame, sampled: bool, k: int | None) -> DataFrame:
    """``_v, _node, _n, _central, _left, _m``: the rarest values of each set that another set holds too, with the list's length.

    ``_left`` counts the values of the set from this one on, in the order from rare to
    frequent.  For full sets, where a linked pair's first common value leaves at least the
    overlap that their sizes ask for, rows that leave too few for any partner are let go.

    ``values`` has one row per (node, retained value), ``nodes`` the set sizes.  ``_central`` is high for a set
    whose values many others hold.
    """
    counts = values.groupBy("_v").agg(F.count(F.lit(1)).alias("_c"), F.min("_node").alias("_a"), F.max("_node").alias("_b")).filter("_c > 1")
    counts = written(counts)
    twice = counts.filter("_c = 2").select("_v", "_c", F.explode(F.array("_a", "_b")).alias("_node"))
    more = counts.filter("_c > 2").select("_v", "_c")
    if more.count() <= BROADCAST_VALUES:
        more = F.broadcast(more)
    shared = twice.unionByName(values.join(more, "_v").select("_v", "_c", "_node"))
    grouped = shared.groupBy("_node").agg(F.sort_array(F.collect_list(F.struct("_c", "_v"))).alias("_l"), F.sum("_c").alias("_central")).join(nodes.select("_node", "_n"), "_node")
    size = F.least("_n", F.lit(k)) if k else F.col("_n")
    free = size - F.size("_l")  # values that no other set holds come first and need no list
    length = F.greatest(F.lit(0), size - _overlap(size, k) + 1 - free).cast("int")
    rows = grouped.select("_node", "_n", "_central", free.alias("_free"), F.posexplode(F.slice("_l", F.lit(1), length)).alias("_at", "_x"))
    rows = written(rows.select("_node", "_n", "_central", (F.col("_n") - F.col("_free") - F.col("_at")).alias("_left"), F.col("_x._v").alias("_v")))
    if not sampled:
        smallest = rows.groupBy("_v").agg(F.min("_n").alias("_least"))
        rows = rows.join(smallest, "_v").filter(F.col("_left") >= _shared_at_least(F.col("_n"), F.greatest("_least", _overlap(F.col("_n"), None)))).drop("_least")
        rows = written(rows)  # so that the lengths below are counted before the shuffle: a long list is many rows of one key
    lengths = rows.groupBy("_v").agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1")
    return rows.join(lengths, "_v")


def _shared_at_least(a: Column, b: Column) -> Column:
    """Shingles that sets of sizes a and b share if they are linked."""
    both = LEAST[0] + LEAST[1]
    return F.floor(((a + b) * LEAST[0] + both - 1) / both)


def _short_pairs(lists: DataFrame) -> DataFrame:
    """All pairs of the short lists."""
    short = lists.filter(F.col("_m") <= SHORT_LIST).groupBy("_v").agg(F.sort_array(F.collect_list("_node")).alias("_l"))
    pairs = F.expr("flatten(transform(sequence(0, size(_l) - 2), i -> transform(slice(_l, i + 2, size(_l)), b -> named_struct('_a', _l[i], '_b', b))))")
    return short.select(F.explode(pairs).alias("_p")).select("_p._a", "_p._b").distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("_x", "_y").alias("_a"), F.greatest("_x", "_y").alias("_b")).distinct()


def _links(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """The pairs that are links: first by the estimate of the union sketch, then exactly."""
    sk = sketches.select("_node", "_n", "_sketch")
    est = pairs.join(sk.select(F.col("_node").alias("_a"), F.col("_n").alias("_na"), F.col("_sketch").alias("_sa")), "_a")
    est = est.join(sk.select(F.col("_node").alias("_b"), F.col("_n").alias("_nb"), F.col("_sketch").alias("_sb")), "_b")
    union = F.slice(F.array_sort(F.array_union("_sa", "_sb")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("_sa", "_sb")))
    least, most = F.least("_na", "_nb"), F.greatest("_na", "_nb")
    share = LEAST[0] / LEAST[1]
    floor = math.floor(k * share - SIGMAS * math.sqrt(k * share * (1 - share)))
    est = est.filter((least * LEAST[1] >= most * LEAST[0]) & ((F.size(union) < k) | (both >= floor))).select("_a", "_b")
    full = est.join(sets.select(F.col("_node").alias("_b"), F.col("_n").alias("_nb"), F.col("_set").alias("_tb")), "_b")
    full = full.join(sets.select(F.col("_node").alias("_a"), F.col("_n").alias("_na"), F.col("_set").alias("_ta")), "_a")
    shared = F.size(F.array_intersect("_ta", "_tb"))
    return full.filter(shared * LEAST[1] >= (F.col("_na") + F.col("_nb") - shared) * LEAST[0]).select("_a", "_b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two texts are linked if 100 times the intersection of their shingle sets is at least 75
    times the union.  ``component_id`` is the smallest id reachable over links, the row's
    own included.  A text without words (null, empty, blank) has no shingles and is linked
    with nothing.  A text of fewer words than a shingle has one shingle.  Ids may be of any
    ordered type.  Rows with a null id take no part (``component_id`` null, kept).  Repeated rows share a class.  A text of
    any length is hashed whole.  Other columns are not read; an empty table gives no rows.
    """
    rows = written(_sets(docs, id_col, text_col, k))
    total = rows.count()
    alive = rows.filter("_n > 0 AND _id IS NOT NULL")
    reps = alive.groupBy("_fp").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_copies"), F.first("_n").alias("_n"), F.first("_sketch").alias("_sketch"))
    reps = written(reps.withColumn("_node", F.monotonically_increasing_id()))  # numbers hold from here on, as the table is written
    lists = written(_prefix_lists(reps.select("_node", F.explode("_sketch").alias("_v")), reps, True, k))
    short = written(_short_pairs(lists))
    in_long = lists.filter(F.col("_m") > SHORT_LIST).select("_node").distinct()
    wanted = short.select(F.explode(F.array("_a", "_b")).alias("_node")).union(in_long).distinct()
    sets = written(_full_sets(docs, reps.select("_node", "_rep", "_fp", "_n").join(wanted, "_node", "left_semi"), id_col, text_col))
    hot_sets = sets.join(in_long, "_node", "left_semi")
    again = written(_prefix_lists(hot_sets.select("_node", F.explode("_set").alias("_v")), hot_sets, False, None))
    long = again.filter(F.col("_m") > SHORT_LIST)
    sketches = reps.join(sets.select("_node"), "_node", "left_semi")
    pivots = long.groupBy("_v").agg(F.max_by("_node", F.struct("_central", "_node")).alias("_pivot"))
    star = _ordered(long.join(pivots, "_v").filter("_node <> _pivot").select(F.col("_node").alias("_x"), F.col("_pivot").alias("_y")))
    links = written(_links(short.unionByName(_short_pairs(again)).unionByName(star).distinct(), sketches, sets, k))
    labels = components(links)
    for turn in range(PIVOT_ROUNDS):
        last = turn == PIVOT_ROUNDS - 1
        tagged = written(long.join(labels, "_node", "left").withColumn("_label", F.coalesce("_label", "_node")).select("_v", "_node", "_n", "_left", "_central", "_label"))
        # Of each component in a list its size and its most central member, added up before the shuffle.
        parts = written(tagged.groupBy("_v", "_label").agg(F.count(F.lit(1)).alias("_size"), F.max(F.struct("_central", "_node", "_n", "_left")).alias("_best")))
        core = parts.groupBy("_v").agg(F.max_by("_label", F.struct("_size", "_label")).alias("_core"), F.count(F.lit(1)).alias("_parts")).filter("_parts > 1")
        core = written(core)
        if not core.limit(1).count():
            break
        if last:
            rest = tagged.join(core, "_v").filter("_label <> _core")
        else:
            one = written(parts.join(core, "_v").filter("_label <> _core").select("_v", F.struct("_best", "_label").alias("_one"))).groupBy("_v").agg(F.max("_one").alias("_one"))
            rest = one.select("_v", F.col("_one._label").alias("_label"), "_one._best.*")
        other = rest.select("_v", F.col("_node").alias("_y"), F.col("_label").alias("_ly"), F.col("_n").alias("_ny"), F.col("_left").alias("_lefty"))
        near = (F.col("_label") != F.col("_ly")) & (F.least("_left", "_lefty") >= _shared_at_least(F.col("_n"), F.col("_ny")))
        open_pairs = _ordered(tagged.withColumnRenamed("_node", "_x").join(other, "_v").filter(near).select("_x", "_y"))
        more = written(_links(open_pairs, sketches, sets, k))
        found = more.limit(1).count() > 0
        if found:
            links = links.unionByName(more)
            labels = components(links)
    named = reps.select("_node", "_rep", "_fp", "_copies").join(labels, "_node", "left").withColumn("_label", F.coalesce("_label", "_node"))
    named = written(named)
    roots = named.groupBy("_label").agg(F.min("_rep").alias("component_id"))
    classes = named.join(roots, "_label").select("_fp", "component_id", "_copies")
    out = join_groups(rows.select("_id", "_n", "_fp"), classes, ["_fp"], "_copies", total, F.col("_id"))
    component = F.when(F.col("_n") > 0, F.col("component_id")).otherwise(F.col("_id"))
    out = out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.when(F.col("_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """The rows of ``docs`` that stay: of each near-duplicate group the one with the smallest id.

    Rows that repeat an id with the same text stay once; rows with a null id all stay.
    """
    groups = near_duplicates(docs, id_col, text_col, k)
    repeated = groups.filter(F.col(id_col).isNotNull()).groupBy(id_col).count().filter("count > 1").limit(1).count()
    dropped = groups.filter("NOT kept").select(id_col).distinct()
    kept = docs.join(dropped, id_col, "left_anti").select(*docs.columns)
    return kept.dropDuplicates([id_col, text_col]) if repeated else kept

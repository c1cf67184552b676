"""Katz backoff language model of any order: discounted n-grams over discounted shorter ones, exactly normalised.

Every scan task cuts its texts into blocks of about ``BLOCK_BYTES`` and writes each once as
its distinct word hashes and a word number for each token; texts themselves are never
shuffled.  A block sends its distinct n-grams of every order with their training counts, as
sorted packed keys, to the table partition that the key's leading bits name; a partition
adds up the counts of its keys and answers each block in the order that it asked.  Counts
are pre-aggregated by block, so a frequent n-gram is one entry per block, and partitions are
even because keys are hashes.  Backoff weights make the same way: every n-gram is taken into
account by exactly one block that holds it, and a block asks only for the weights of
histories that it has to back off from.

P(v | h) = d(c(hv)) c(hv) / c(h)            if the n-gram hv occurs ``min_count`` times or more
         = alpha(h) P(v | h')               otherwise; h' is h without its first word
         = P(v | h')                        if h never occurs
P(v)     = d(c(v)) c(v) / N                 if c(v) > 0
         = what the discounts leave         for the one event of an unknown word
alpha(h) = (1 - sum of the first line over v) / (1 - sum of P(v | h') over the same v)

Discounts d are Good-Turing for counts up to ``GT_MAX``.  Higher counts are reliable and give
up ``RESERVE`` of one event only, so that every history leaves something to back off with.
The history of a text's first words is filled up with start symbols; the end is a token.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._spark import written
from ._words import mix, word_hashes

BLOCK_BYTES = 8 << 20
#: Keys that one table partition gets on average, repeats from different blocks counted.
PARTITION_KEYS = 1_000_000
#: Longest n-grams of the model.
ORDER = 2
GT_MAX = 5
RESERVE = 0.1
_END, _START = np.uint64(0x8F3A_51C6_0D27_B94E), np.uint64(0x5B1D_77E2_91C4_6A03)
_A, _B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
ALPHA = 100


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as the first key and six-byte (or, with a gap too wide, eight-byte) differences."""
    if not len(keys):
        return b""
    gaps = np.diff(keys)
    width = 6 if not len(gaps) or int(gaps.max()) < 1 << 48 else 8
    return bytes([width]) + keys[:1].tobytes() + gaps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    low = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :width] = low
    with np.errstate(over="ignore"):
        return np.cumsum(np.concatenate([np.frombuffer(data[1:9], np.uint64), wide.view(np.uint64).ravel()]), dtype=np.uint64)


def _zip(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them, or floats, compressed."""
    if values.dtype.kind == "f":
        return b"\0" + zlib.compress(values.astype("<f8").tobytes(), 1)
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - (w == 8)))
    return bytes([width]) + zlib.compress(values.astype(f"<u{width}").tobytes(), 1)


def _unzip(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data[1:])
    return np.frombuffer(raw, f"<u{data[0]}").astype(np.int64) if data[0] else np.frombuffer(raw, "<f8")


def discounts(n: list[int], first: int) -> np.ndarray:
    """d(r) for r up to GT_MAX from the counts of counts ``n[r]``; 0 below ``first``.

    For ``first`` 1 the discounted mass is the Good-Turing mass of single events.  A value
    that is not strictly between 0 and 1 (sparse counts) gives way to (r - 1/2) / r.
    """
    out = np.zeros(GT_MAX + 1)
    common = (GT_MAX + 1) * n[GT_MAX + 1] / n[1] if first == 1 and n[1] else 0.0
    for r in range(first, GT_MAX + 1):
        d = ((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common) if n[r] and common < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Smoothing:
    """The global numbers of the model: N, V and the discounts of each order, from counts of counts ``spreads[order]``."""

    def __init__(self, spreads: dict[int, list[int]], order: int, min_count: int) -> None:
        none = [0] * (GT_MAX + 4)
        ones = spreads.get(1, none)
        self.tokens, self.types, self.order, self.min_count = ones[-2], ones[-1], order, min_count
        self.d = {n: discounts(spreads.get(n, none), 1 if n == 1 else min_count) for n in range(1, order + 1)}
        left = sum((1 - self.d[1][r]) * r * ones[r] for r in range(1, GT_MAX + 1)) + RESERVE * (ones[-1] - sum(ones[1 : GT_MAX + 1]))
        self.unknown = left / self.tokens if self.tokens else 1.0

    def events(self, n: int, counts: np.ndarray) -> np.ndarray:
        """Discounted counts d(c) c."""
        return np.where(counts <= GT_MAX, self.d[n][np.minimum(counts, GT_MAX)] * counts, counts - RESERVE)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.events(1, counts) / max(1, self.tokens), self.unknown)

    def seen(self, n: int, counts: np.ndarray, history: np.ndarray) -> np.ndarray:
        return self.events(n, counts) / np.maximum(history, 1)


def start_key(n: int) -> np.uint64:
    """The key of a history of n start symbols."""
    return mix(np.array([_START + np.uint64(n)]))[0]


class Grams:
    """The distinct n-grams of a block by order.

    ``keys[n]`` are sorted; ``at[n]`` numbers the n-gram that ends at each token.  Of each
    distinct n-gram ``history[n]`` numbers the shorter one before its last word (the number
    behind the last is the history of start symbols) and ``lower[n]`` the one without its
    first word.
    """

    def __init__(self, words: np.ndarray, token: np.ndarray, sizes: np.ndarray, order: int) -> None:
        self.keys, self.at, self.history, self.lower = {1: words}, {1: token}, {}, {}
        tokens = words[token]
        first = np.zeros(len(tokens), bool)
        first[np.cumsum(sizes) - sizes] = True
        key = tokens
        for n in range(2, order + 1):
            before = np.concatenate([[_START], key[:-1]])
            before[first] = start_key(n - 1)
            with np.errstate(over="ignore"):
                key = mix(mix(before * _A) + tokens * _B)
            self.keys[n], place, self.at[n] = np.unique(key, return_index=True, return_inverse=True)
            self.history[n] = np.where(first[place], len(self.keys[n - 1]), self.at[n - 1][np.maximum(place - 1, 0)])
            self.lower[n] = self.at[n - 1][place]


def _split(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(partition, start, stop) of the sorted keys by their leading bits."""
    if not len(keys):
        return
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip(np.concatenate([[0], edges]), np.append(edges, len(keys)), strict=True):
        yield int(part[a]), int(a), int(b)


def _rows(table: pa.Table, *columns: str) -> list[tuple]:
    return list(zip(*[table[c].to_pylist() for c in columns], strict=True))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [x.rsplit(" ", 1) for x in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def _token_blocks(rows: DataFrame) -> DataFrame:
    """One row a block: ``_block, _ids, _train, _sizes`` (tokens of each text), ``_words`` (distinct hashes) and ``_tokens`` (their numbers in order)."""

    def block(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        ids, train = (pa.concat_arrays([p.column(i) for p in parts]) for i in (0, 1))
        texts = [t for p in parts for t in p.column(2).to_pylist()]
        hashes, sizes = [], []
        for _, _, found, bounds in word_hashes(texts):
            hashes.append(np.insert(found, bounds[1:], _END))
            sizes.append(np.diff(bounds) + 1)
        words, token = np.unique(np.concatenate(hashes), return_inverse=True)
        one = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, train)]
        return pa.RecordBatch.from_arrays([pa.array([number]), *one, pa.array([_zip(np.concatenate(sizes))]), pa.array([pack_keys(words)]), pa.array([_zip(token)])], names=["_block", "_ids", "_train", "_sizes", "_words", "_tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            at = 0
            while at < len(ends):
                done = int(ends[at - 1]) if at else 0
                stop = max(at + (not held), int(np.searchsorted(ends, done + BLOCK_BYTES - size, "right")))
                if stop > at:
                    held.append(batch.slice(at, stop - at))
                    size += int(ends[stop - 1]) - done
                if stop < len(ends) or size >= BLOCK_BYTES:
                    yield block(held, number)
                    number, held, size = number + 1, [], 0
                at = stop
        if held:
            yield block(held, number)

    id_type = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField("_block", T.LongType()), T.StructField("_ids", T.ArrayType(id_type)), T.StructField("_train", T.ArrayType(T.BooleanType())), *[T.StructField(c, T.BinaryType()) for c in ("_sizes", "_words", "_tokens")]])
    return rows.select("_id", "_train", "_text").mapInArrow(cut, schema)


def score_texts(docs: DataFrame, train: str = "_train", id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, min_count: int = 1) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    ``docs`` has a boolean column ``train``; only its true rows are counted.  Scores are log10
    probabilities of the words and one end symbol.  ``order`` is the length of the longest
    n-grams; n-grams (not words) of fewer than ``min_count`` occurrences count as unseen.
    Null and empty texts are the end symbol alone; ids may be of any type, null ids and
    repeated rows are scored (and counted) like any row; texts of any length are read whole;
    other columns are not read; an empty table gives no rows.  With nothing to train on
    every word is the unknown word.  Counts are 64-bit.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(train), F.lit(False)).alias("_train"), F.col(text_col).alias("_text"))
    blocks = written(_token_blocks(rows))
    tokens = blocks.agg(F.sum(F.expr("octet_length(_words) / 7 + octet_length(_tokens) / 3"))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, tokens / PARTITION_KEYS)))))
    kinds = range(1, order + 1)

    def grams(row: dict) -> tuple[Grams, np.ndarray, np.ndarray]:
        """The n-grams of a block, the text of each token, and whether it is trained on."""
        sizes = _unzip(row["_sizes"])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return Grams(unpack_keys(row["_words"]), _unzip(row["_tokens"]), sizes, order), owner, np.array(row["_train"], bool)[owner]

    asks = "_kind int, _p long, _block long, _keys binary, _data binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, _, trained = grams(row)
                out = []
                for n in kinds:
                    keys = found.keys[n]
                    counts = np.bincount(found.at[n][trained], minlength=len(keys))
                    out += [(n, p, row["_block"], pack_keys(keys[a:b]), _zip(counts[a:b])) for p, a, b in _split(keys, bits)]
                yield from _table(out, asks).to_batches()

    answers = "_kind int, _p long, _block long, _data binary, _own binary, _spread array<long>"

    def add(table: pa.Table) -> pa.Table:
        """Adds up the counts of the keys of one partition; of each key the first block that asks accounts for it."""
        rows = _rows(table, "_kind", "_p", "_block", "_keys", "_data")
        asked = [unpack_keys(r[3]) for r in rows]
        keys, first, at = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, at, np.concatenate([_unzip(r[4]) for r in rows]))
        spread = np.bincount(np.minimum(totals, GT_MAX + 2), minlength=GT_MAX + 3)[: GT_MAX + 2].tolist() + [int(totals.sum()), int((totals > 0).sum())]
        known, own = totals[at], np.zeros(len(at), bool)
        own[first] = True
        ends = np.cumsum([len(x) for x in asked])
        return _table([(r[0], r[1], r[2], _zip(known[e - len(x) : e]), np.packbits(own[e - len(x) : e]).tobytes(), None if i else spread) for i, (r, x, e) in enumerate(zip(rows, asked, ends, strict=True))], answers)

    counts = written(blocks.select("_block", "_train", "_sizes", "_words", "_tokens").mapInArrow(ask, asks).groupBy("_kind", "_p").applyInArrow(add, answers))
    width = GT_MAX + 4
    sums = counts.filter("_spread IS NOT NULL").groupBy("_kind").agg(*[F.sum(F.element_at("_spread", i + 1)).alias(f"s{i}") for i in range(width)]).collect()  # one row an order
    smooth = Smoothing({r["_kind"]: [r[f"s{i}"] or 0 for i in range(width)] for r in sums}, order, min_count)

    def known(found: Grams, table: pa.Table) -> tuple[dict, dict, dict]:
        """By order: the count of each n-gram, whether this block accounts for it, and the count of its history."""
        got = {(k, p): (_unzip(d), np.unpackbits(np.frombuffer(o, np.uint8)).astype(bool)) for k, p, d, o in _rows(table, "_kind", "_p", "_data", "_own") if k < ALPHA}
        count, own, history = {}, {}, {}
        for n in kinds:
            parts = [got[n, p] for p, _, _ in _split(found.keys[n], bits)]
            count[n] = np.concatenate([c for c, _ in parts]) if parts else np.zeros(0, np.int64)
            own[n] = np.concatenate([o[: len(c)] for c, o in parts]) if parts else np.zeros(0, bool)
            if n > 1:
                texts = count[1][np.searchsorted(found.keys[1], _END)]  # as many ends as texts, hence as starts
                history[n] = np.append(count[n - 1], texts)[found.history[n]]
                count[n] = np.where(count[n] >= min_count, count[n], 0)
        return count, own, history

    shares = "_kind int, _p long, _block long, _keys binary, _seen binary, _lower binary, _need binary"

    def asked_histories(found: Grams, count: dict, history: dict, n: int) -> np.ndarray:
        """Keys of the histories that the block backs off from."""
        every = np.append(found.keys[n - 1], start_key(n - 1))
        return np.sort(every[np.unique(found.history[n][(count[n] == 0) & (history[n] > 0)])])

    def account(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            found, _, _ = grams(row)
            count, own, history = known(found, right)
            for n in range(2, order + 1):
                every = np.append(found.keys[n - 1], start_key(n - 1))
                kept = own[n] & (count[n] > 0)
                low = found.lower[n][kept]
                lower = smooth.unigram(count[1][low]) if n == 2 else smooth.seen(n - 1, count[n - 1][low], history[n - 1][low])
                seen = np.bincount(found.history[n][kept], smooth.seen(n, count[n][kept], history[n][kept]), len(every))
                lower = np.bincount(found.history[n][kept], lower, len(every))
                some = np.flatnonzero(seen > 0)
                some = some[np.argsort(every[some])]
                need = asked_histories(found, count, history, n)
                needs = {p: pack_keys(need[a:b]) for p, a, b in _split(need, bits)}
                gives = {p: (pack_keys(every[some[a:b]]), _zip(seen[some[a:b]]), _zip(lower[some[a:b]])) for p, a, b in _split(every[some], bits)}
                out += [(ALPHA + n, p, row["_block"], *gives.get(p, (None, None, None)), needs.get(p)) for p in sorted(needs.keys() | gives.keys())]
        return _table(out, shares)

    weights = "_kind int, _p long, _block long, _data binary, _own binary"

    def weigh(table: pa.Table) -> pa.Table:
        """Backoff weights of the histories that a block asks for; every one of them was seen, so some block has given its sums."""
        rows = _rows(table, "_kind", "_p", "_block", "_keys", "_seen", "_lower", "_need")
        given = [r for r in rows if r[3]]
        keys, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *[unpack_keys(r[3]) for r in given]]), return_inverse=True)
        seen, lower = (np.bincount(at, np.concatenate([np.zeros(0), *[_unzip(r[i]) for r in given]]), len(keys)) for i in (4, 5))
        alpha = (1 - seen) / np.maximum(1 - lower, 1e-12)
        out = []
        for r in rows:
            if r[6]:
                need = unpack_keys(r[6])
                place = np.minimum(np.searchsorted(keys, need), max(0, len(keys) - 1))
                found = keys[place] == need if len(keys) else np.zeros(len(need), bool)
                out.append((r[0], r[1], r[2], _zip(np.where(found, alpha[place] if len(keys) else 1.0, 1.0)), None))
        return _table(out, weights)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            found, owner, _ = grams(row)
            count, _, history = known(found, right)
            alphas = {(k, p): _unzip(d) for k, p, d in _rows(right, "_kind", "_p", "_data") if k > ALPHA}
            p = smooth.unigram(count[1])
            for n in range(2, order + 1):  # the recursion, one order after another for all n-grams of the block
                every = np.append(found.keys[n - 1], start_key(n - 1))
                need = asked_histories(found, count, history, n)
                alpha = np.ones(len(every))
                if len(need):
                    ranks = np.argsort(every)
                    alpha[ranks[np.searchsorted(every, need, sorter=ranks)]] = np.concatenate([alphas[ALPHA + n, part] for part, _, _ in _split(need, bits)])
                p = np.where(count[n] > 0, smooth.seen(n, count[n], history[n]), alpha[found.history[n]] * p[found.lower[n]])
            token = found.at[1]
            base = np.log10((count[1] + 1) / (smooth.tokens + smooth.types + 1))[token]
            add_up = lambda x: np.bincount(owner, x, len(row["_train"]))
            out.append((add_up(np.ones(len(token))).astype(np.int64), add_up(count[1][token] > 0).astype(np.int64), add_up(base), add_up(np.log10(p)[found.at[order]])))
        flat = [np.concatenate([x[i] for x in out]) if out else np.zeros(0, "i8" if i < 2 else "f8") for i in range(4)]
        ids, trains = (left[c].combine_chunks().flatten() for c in ("_ids", "_train"))
        return pa.table([ids, trains, *map(pa.array, flat)], names=["_id", "_train", "n_tokens", "n_known", "base_score", "score"])

    by_block = blocks.groupBy("_block")
    counts = counts.select("_kind", "_p", "_block", "_data", "_own")
    parts = by_block.cogroup(counts.groupBy("_block")).applyInArrow(account, shares)
    alphas = parts.groupBy("_kind", "_p").applyInArrow(weigh, weights)
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("_train", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")], *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]])
    out = by_block.cogroup(counts.unionByName(alphas).groupBy("_block")).applyInArrow(score, schema)
    return out.select(F.col("_id").alias(id_col), F.col("_train").alias(train), "n_tokens", "n_known", F.lit(smooth.tokens).cast("long").alias("train_tokens"), "base_score", "score")

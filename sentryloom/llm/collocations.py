"""Phrase collocations from a weighted de Bruijn graph of word n-grams.

An edge is an n-gram of the greatest length (``max_words``) between the two shorter n-grams
that overlap in it.  At the end of a piece the shorter n-grams that no edge leaves are
edges into the end.  So every occurrence of an n-gram is one unit of flow through its node,
and all shorter counts are sums of edges and of these corrections: only edges are counted.

First scan: words by language, and n-grams that are frequent by themselves (hot).  Every
word of a phrase of ``min_count`` occurrences has as many, so the second scan cuts pieces at
rarer words (a Bloom filter of fixed largest size says which; a rare word that it lets
through costs space only).  Up to ``LISTED_WORDS`` frequent words are numbered, and edges
are sent as numbers; beyond, each message has the words that it needs.  A block of texts sends its distinct edges with their counts to
the bucket of their first two words, or of as many words as it takes until the beginning is
not hot, so no beginning fills a bucket.  A bucket sorts its edges; the flow of a node is the
sum of a range.  Nodes whose whole flow goes on to one longer node form unary paths, given
as one row.  Beginnings that are hot get a part of their count from each bucket.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _bloom
from ._spark import small, written
from ._words import _hash_slice, lowered, mix

MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
BLOCK_BYTES = 4 << 20
FILTER_BYTES = 64 << 20
#: Up to so many frequent words every task gets the list of them, and edges are sent as its numbers; beyond, with their words.
LISTED_WORDS = 1_000_000
#: Edges that a bucket gets on average, repeats from different blocks counted.
BUCKET_EDGES = 1_000_000
#: An n-gram is hot if it may be one of so many in all; at most so many of each length are.
HOT_SHARE = 20_000
#: Rows of a language that one task orders first.
TOP_ROWS = 100_000

_U = np.uint64
_A, _END = _U(0xA24BAED4963EE407), _U(0x8F3A51C60D27B94E)
#: What a byte is: 0 part of a word, 1 blank, 2 end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32, all first bytes first, compressed."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    width = max(1, -(-int(values.max()).bit_length() // 8)) if values.size else 1
    return bytes([width]) + zlib.compress(np.ascontiguousarray(planes[:, :width].T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u4").ravel()


class Block:
    """The words of some texts: ``words`` (distinct, as bytes), ``at`` (number of each token's word), ``lang`` of each token, and ``left`` tokens from each to the end of its piece."""

    def __init__(self, langs: list[str], texts: list[bytes]) -> None:
        data = b"\n".join(texts) + b"\n"
        a = np.frombuffer(data, np.uint8)
        kind = _KIND[a]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edge[0::2], edge[1::2]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        tokens = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(a[inside].tobytes())]).dictionary_encode()
        self.at, self.words = tokens.indices.to_numpy().astype(np.int64), tokens.dictionary
        self.names, number = np.unique(np.array(langs, object), return_inverse=True)
        firsts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.lang = number[np.searchsorted(firsts, starts, "right") - 1] if len(starts) else np.zeros(0, np.int64)
        piece = np.cumsum(kind == 2)[starts]
        self.left = self._until(np.append(piece[1:] != piece[:-1], True) if len(piece) else np.zeros(0, bool))
        self.hashes = word_hashes(self.words.to_pylist())
        self.lang_hashes = hash_names(self.names.tolist())

    @staticmethod
    def _until(last: np.ndarray) -> np.ndarray:
        """Tokens from each one to the next that is last, itself included."""
        ends = np.flatnonzero(last)
        return np.repeat(ends, np.diff(ends, prepend=-1)) + 1 - np.arange(len(last)) if len(last) else np.zeros(0, np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (lang, word) codes with their counts, and the number of each token's."""
        codes = self.lang * len(self.words) + self.at
        values, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
        return values, counts, inverse

    def pair_hashes(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(self.hashes[codes % max(1, len(self.words))] + self.lang_hashes[codes // max(1, len(self.words))])

    def prefix_hashes(self, lang: np.ndarray, grams: np.ndarray) -> Iterator[np.ndarray]:
        """Hashes of the first 1, 2, ... words of rows of word numbers from 1; 0 is the end."""
        return gram_hashes(self.lang_hashes[lang], self.hashes, grams)

    def grams(self, left: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """The word numbers (from 1) of up to ``size`` words from each token on; 0 where the piece has ended."""
        padded = np.concatenate([self.at + 1, np.zeros(size, np.int64)]).astype(np.int32)
        return np.stack([np.where(k < left[at], padded[at + k], 0) for k in range(size)], axis=1).astype(np.int32)


def gram_hashes(lang: np.ndarray, words: np.ndarray, grams: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the first 1, 2, ... words of each row, from the hash of its language and the hashes of words."""
    known = np.concatenate([[_END], words])
    with np.errstate(over="ignore"):
        value = lang
        for column in grams.T:
            value = mix(value * _A + known[column])
            yield value


def word_hashes(words: list[bytes]) -> np.ndarray:
    return _hash_slice(b" ".join(words) + b" ")[2] if words else np.zeros(0, np.uint64)


def hash_names(names: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=8).digest()) for x in names], np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of about ``BLOCK_BYTES``; a longer text is cut between pieces."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            data = lowered(text.as_py())
            for part in _cut(data):
                langs.append(lang.as_py())
                texts.append(part)
                size += len(part)
                if size >= BLOCK_BYTES:
                    yield Block(langs, texts)
                    langs, texts, size = [], [], 0
    if texts:
        yield Block(langs, texts)


def _cut(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data) and _KIND[data[end]] != 2:
            end += 1
        yield data[at:end]
        at = end


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).filter("text <> ''")


def _first_scan(rows: DataFrame, max_words: int, min_count: int) -> DataFrame:
    """Rows ``kind, lang, word, hash, n``: kind 0 all words of a language, 1 words of ``min_count`` or more, k hot candidates of k words by hash."""
    schema = "kind int, lang string, word string, hash long, n long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            if not len(block.at):
                continue
            codes, counts, _ = block.pairs()
            lang, word = codes // len(block.words), codes % len(block.words)
            names = pa.array(block.names.tolist(), pa.string())
            totals = np.bincount(lang, counts, len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(names), np.int32)), names, pa.nulls(len(names), pa.string()), pa.nulls(len(names), pa.int64()), pa.array(totals)], names=["kind", "lang", "word", "hash", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(codes), np.int32)), names.take(pa.array(lang)), block.words.take(pa.array(word)).cast(pa.large_string()).cast(pa.string()), pa.nulls(len(codes), pa.int64()), pa.array(counts)], names=["kind", "lang", "word", "hash", "n"])
            at = np.flatnonzero(block.left > 1)
            left, grams = block.left[at], block.grams(block.left, at, max_words - 1)
            for k, value in enumerate(block.prefix_hashes(block.lang[at], grams), 1):
                if k > 1:
                    found, n = np.unique(value[left >= k], return_counts=True)
                    often = n >= max(2, len(block.at) // (2 * HOT_SHARE))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(int(often.sum()), k, np.int32)), pa.nulls(int(often.sum()), pa.string()), pa.nulls(int(often.sum()), pa.string()), pa.array(found[often].view(np.int64)), pa.array(n[often])], names=["kind", "lang", "word", "hash", "n"])

    summed = rows.mapInArrow(scan, schema).groupBy("kind", "lang", "word", "hash").agg(F.sum("n").alias("n"))
    return written(summed.filter((F.col("kind") != 1) | (F.col("n") >= min_count)))


def gram_paths(rows: DataFrame, first: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Unary paths of the graph: ``lang, words, lo, hi, n, whole``.

    The first ``lo`` to ``hi`` of ``words`` are n-grams of the same count ``n``.  Rows that are
    not ``whole`` have parts of the count of a hot beginning (lo = hi).
    """
    counted = first.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    sizes = {r["kind"]: r for r in counted}
    tokens = sizes[0]["n"] if 0 in sizes else 0
    frequent = sizes[1]["rows"] if 1 in sizes else 0

    def pair_hashes(batch: pa.RecordBatch) -> np.ndarray:
        found = word_hashes(batch.column(1).cast(pa.binary()).to_pylist())
        names, number = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        with np.errstate(over="ignore"):
            return mix(found + hash_names(names.tolist())[number])

    sc = rows.sparkSession.sparkContext
    bloom = _bloom.filled(first.filter("kind = 1").select("lang", "word"), pair_hashes, frequent, filter_bytes)
    hot = {k: [] for k in range(2, max_words)}
    for r in first.filter((F.col("kind") > 1) & (F.col("n") >= max(2, tokens // (2 * HOT_SHARE)))).select("kind", "hash").collect():  # at most 2 HOT_SHARE of a length
        hot[r["kind"]].append(r["hash"])
    listed = None
    if frequent <= LISTED_WORDS:
        words = first.filter("kind = 1").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").select(F.col("word").cast("binary").alias("word")).toArrow()
        listed = words["word"].combine_chunks().cast(pa.large_binary())
    known = sc.broadcast((bloom, listed, {k: np.sort(np.array(v, np.int64).view(np.uint64)) for k, v in hot.items()}))
    buckets = max(1, -(-tokens // BUCKET_EDGES))
    messages = "bucket long, langs array<string>, words binary, edges binary, counts binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, listed, often = known.value
        for block in _blocks(batches):
            if not len(block.at):
                continue
            codes, _, inverse = block.pairs()
            kept = _bloom.has(filled, block.pair_hashes(codes))[inverse]
            number = pc.index_in(block.words, listed) if listed is not None else None
            if number is not None:
                kept &= number.is_valid().to_numpy(zero_copy_only=False)[block.at]
            ends = ~kept | (block.left == 1)  # a rare word ends the piece before it
            ends[:-1] |= ~kept[1:]
            left = block._until(ends)
            at = np.flatnonzero(kept & (left > 1))
            if not len(at):
                continue
            edges = np.concatenate([block.lang[at, None].astype(np.int32), block.grams(left, at, max_words)], axis=1)
            edges, counts = summed_edges(edges, np.ones(len(edges), np.int64))
            prefixes = list(block.prefix_hashes(edges[:, 0], edges[:, 1:]))
            route, split = prefixes[1].copy(), np.ones(len(edges), bool)
            for k in range(2, max_words):
                split &= np.isin(prefixes[k - 1], often[k])
                route[split] = prefixes[k][split]
            bucket = (((route >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
            if number is not None:
                edges[:, 1:] = np.concatenate([[0], number.fill_null(0).to_numpy().astype(np.int32) + 1])[edges[:, 1:]]
            order = np.argsort(bucket, kind="stable")
            bucket, edges, counts = bucket[order], edges[order], counts[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
            out = []
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                langs, lang = np.unique(edges[low:high, 0], return_inverse=True)
                grams, words = edges[low:high, 1:], None
                if number is None:
                    used, grams = np.unique(np.append(grams, 0), return_inverse=True)
                    grams = grams[:-1].reshape(high - low, -1)
                    words = zlib.compress(b" ".join(block.words.take(pa.array(used[1:] - 1)).to_pylist()), 1)
                table = np.concatenate([lang.reshape(1, -1), grams.T])
                out.append((int(bucket[low]), block.names[langs].tolist(), words, _packed(table), _packed(counts[low:high])))
            kinds = (pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["bucket", "langs", "words", "edges", "counts"])

    paths = "lang string, words array<string>, lo int, hi int, n long, whole boolean"

    def flow(table: pa.Table) -> pa.Table:
        _, listed, often = known.value
        rows = list(zip(*[table[c].to_pylist() for c in ("langs", "words", "edges", "counts")], strict=True))
        langs = np.unique(np.array([x for r in rows for x in r[0]], object))
        words, numbers = listed, [None] * len(rows)
        if listed is None:
            parts = [zlib.decompress(r[1]).split(b" ") for r in rows]
            every = pa.array([w for p in parts for w in p], pa.large_binary()).dictionary_encode()
            words, ends = every.dictionary, np.cumsum([0] + [len(p) for p in parts])
            numbers = [np.append(0, every.indices.to_numpy()[a:b] + 1) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        edges = []
        for r, number in zip(rows, numbers, strict=True):
            columns = _unpacked(r[2]).astype(np.int32).reshape(max_words + 1, -1)
            columns[0] = np.searchsorted(langs, np.array(r[0], object))[columns[0]]
            edges.append(columns.T if number is None else np.stack([columns[0], *number[columns[1:]]], axis=1).astype(np.int32))
        edges, counts = summed_edges(np.concatenate(edges), np.concatenate([_unpacked(r[3]) for r in rows]).astype(np.int64))
        flows = node_flows(edges, counts)
        some = np.flatnonzero(flows[:, 1:].max(axis=1, initial=0) >= (1 if any(map(len, often.values())) else min_count))
        edges, flows = edges[some], flows[some]
        split, base, out = np.zeros(len(some), bool), np.full(len(some), 2), []
        text = lambda row, k: [words[int(w) - 1].as_py().decode() for w in edges[row, 1 : k + 1]]
        if any(map(len, often.values())):
            used, local = np.unique(np.append(edges[:, 1:], 0), return_inverse=True)
            known_words = word_hashes(words.take(pa.array(used[1:] - 1)).to_pylist())
            split[:] = True
            for k, value in enumerate(gram_hashes(hash_names(langs.tolist())[edges[:, 0]], known_words, local[:-1].reshape(len(some), -1)), 1):
                if 1 < k < max_words:
                    split &= np.isin(value, often[k])
                    base[split] = k + 1
                    for row in np.flatnonzero(split & (flows[:, k - 1] > 0)).tolist():
                        out.append((langs[edges[row, 0]], text(row, k), k, k, int(flows[row, k - 1]), False))
        for k in range(2, max_words + 1):
            n = flows[:, k - 1]
            opens = (n >= min_count) & (base <= k) & ((base == k) | (flows[:, k - 2] != n))
            for row in np.flatnonzero(opens).tolist():
                high = k
                while high < max_words and flows[row, high] == n[row]:
                    high += 1
                out.append((langs[edges[row, 0]], text(row, high), k, high, int(n[row]), True))
        kinds = (pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int64(), pa.bool_())
        return pa.table([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=["lang", "words", "lo", "hi", "n", "whole"])

    return rows.mapInArrow(send, messages).groupBy("bucket").applyInArrow(flow, paths)


def summed_edges(edges: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order with the sums of their counts."""
    if not len(edges):
        return edges, counts
    keys, room = [], 0  # as many columns in a 64-bit key as fit
    for column in edges.T:
        bits = max(1, int(column.max()).bit_length())
        if room < bits:
            keys.append(np.zeros(len(edges), np.uint64))
            room = 64
        keys[-1] = keys[-1] << _U(bits) | column.astype(np.uint64)
        room -= bits
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    return edges[order[starts]], np.add.reduceat(counts[order], starts)


def node_flows(edges: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For distinct sorted edges (lang, words): at the first edge of each node the flow through it, by number of words less one; 0 elsewhere and behind the end."""
    out = np.zeros((len(edges), edges.shape[1] - 1), np.int64)
    if not len(edges):
        return out
    new = np.append(True, edges[1:, 0] != edges[:-1, 0])
    for k in range(1, edges.shape[1]):
        new = new | np.append(True, edges[1:, k] != edges[:-1, k])
        starts = np.flatnonzero(new)
        out[starts, k - 1] = np.where(edges[starts, k] > 0, np.add.reduceat(counts, starts), 0)
    return out


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, filter_bytes: int = FILTER_BYTES, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    Texts (null: empty) are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and
    at blanks into words; a null language is ``und``.  Phrases of 2 to ``max_words`` words (at
    least 3 as a parameter) with ``a >= min_count`` occurrences are scored by the cut with the
    smallest floor(1000 a n / (l r)) (ties: the earliest), l and r the counts of its sides and
    n all words of the language; whole numbers throughout, products in 38 digits (more is an
    error, not a wrong value).  A phrase inside a longer one of the same count is dropped.
    Order: score and a descending, phrase ascending by its bytes.  Repeated rows count
    each; other columns are not read; an empty table gives no rows.  Words are compared as
    text, hashes only choose buckets.  A piece is held whole by one task.
    """
    if max_words < 3:
        raise ValueError("max_words must be 3 or more")
    rows = _rows(docs, lang_col, text_col)
    first = _first_scan(rows, max_words, min_count)
    paths = written(gram_paths(rows, first, max_words, min_count, filter_bytes))
    length = F.explode(F.sequence("lo", "hi"))
    whole = paths.filter("whole").select("lang", "words", "n", length.alias("k")).select("lang", F.slice("words", F.lit(1), F.col("k")).alias("words"), "k", "n")
    parts = paths.filter("NOT whole").groupBy("lang", "words", F.col("hi").alias("k")).agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    grams = written(whole.unionByName(parts).withColumn("phrase", F.array_join("words", " ")))
    inner = F.explode(F.array(F.slice("words", F.lit(1), F.col("k") - 1), F.slice("words", F.lit(2), F.col("k") - 1)))
    longer = grams.filter("k > 2").select("lang", inner.alias("_words"), "n").select("lang", F.array_join("_words", " ").alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("_longer"))
    kept = grams.join(longer, ["lang", "phrase"], "left").filter("_longer IS NULL OR _longer < n").drop("_longer")
    sides = first.filter("kind = 1").select("lang", F.col("word").alias("_side"), F.col("n").alias("_n")).unionByName(grams.select("lang", F.col("phrase").alias("_side"), F.col("n").alias("_n")))
    cuts = kept.select("lang", "phrase", "words", "k", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("_left"), F.array_join(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("_right"))
    cuts = cuts.join(sides.select("lang", F.col("_side").alias("_left"), F.col("_n").alias("l")), ["lang", "_left"]).join(sides.select("lang", F.col("_side").alias("_right"), F.col("_n").alias("r")), ["lang", "_right"])
    totals = first.filter("kind = 0").select("lang", "n")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.join(small(totals), "lang").withColumn("_top", wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("_under", wide("l") * wide("r"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(F.expr("_top div _under").alias("score"), "cut", "a", "l", "r", "n")).alias("_b"))
    scored = best.select("lang", "phrase", *[f"_b.{c}" for c in ("a", "l", "r", "n", "score")])
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = max(1, -(-grams.count() // TOP_ROWS))
    part = F.pmod(F.xxhash64("phrase"), F.lit(slices))
    scored = scored.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

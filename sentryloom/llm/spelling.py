"""Spelling variants: words one edit away from a much more frequent word, found by Bloom-guided neighbourhoods.

The vocabulary is counted by built-in functions.  Its words go into blocked Bloom filters,
one for each length (``length`` counts code points), which every task gets.  A word's
deletions are asked in the filter of the next shorter length and its replacements in that
of its own; an insertion is a deletion seen from the other word, and of two words that
differ in one letter only the one with the larger letter asks, so every pair is found once.
All edits of a batch are hashed from the words' prefix sums with whole arrays; text is made
only for positives.  Those are shuffled to an exact join with the vocabulary, which removes
what the filters let through by chance.

The filters have a fixed largest size (``filter_bytes``), whatever the vocabulary: beyond
it they let more through, and the join still decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import written
from ._words import mix

FILTER_BYTES = 64 << 20
BITS_PER_WORD = 24
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 7, 2, 10
#: Letters of words: ASCII and Latin-1.
LETTERS = r"A-Za-zÀ-ÿ"
#: (word, place) cells that are edited at a time, and bytes of a filter that one task fills.
CELLS, CHUNK_BYTES = 1 << 17, 1 << 20

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_PINV = _U(pow(_P, -1, 1 << 64))


def plain_lower(word: Column) -> Column:
    """A-Z in lower case and nothing else; the short way for words that are all ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, upper, upper.lower()))


def misspelt(word: Column, key: Column, every: int = 31) -> Column:
    """The word without one code point if ``every`` divides the key."""
    at = F.pmod(key, F.char_length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(key % every == 0, cut).otherwise(word)


def document_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """Rows ``word``: maximal runs of at least ``least`` letters, lower-cased, one in 31 (by document and word) without a letter.

    The key of a run is the crc32 of ``<id>:<run>``; a null id counts as empty text there.
    """
    runs = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), runs.alias("_run"))
    rows = rows.select("_id", plain_lower(F.col("_run")).alias("_run"))
    word = misspelt(F.col("_run"), F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary")))
    return rows.select(word.alias("word")).filter(F.char_length("word") >= least)


class WordFilter:
    """Blocked Bloom filters by word length in one array: a word sets five bits of one 64-bit block of its length's share."""

    def __init__(self, words: dict[int, int], most_bytes: int = FILTER_BYTES, bits: int = BITS_PER_WORD) -> None:
        per_word = min(float(bits), 8 * most_bytes / max(1, sum(words.values())))
        sizes = {length: max(1, math.ceil(n * per_word / 64)) for length, n in words.items()}
        #: Length: (first block, number of blocks, words).
        self.shards: dict[int, tuple[int, int, int]] = {}
        at = 0
        for length in sorted(sizes):
            self.shards[length] = (at, sizes[length], words[length])
            at += sizes[length]
        self.n_blocks = at
        self.blocks = np.zeros(0, np.uint64)

    def places(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block and bits of each hash."""
        first, n, _ = self.shards[length]
        block = ((hashes >> _U(32)) * _U(n)) >> _U(32)
        bits = np.zeros(len(hashes), np.uint64)
        for k in range(5):
            bits |= _U(1) << ((hashes >> _U(6 * k)) & _U(63))
        return block.astype(np.int64) + first, bits

    def has(self, length: int, hashes: np.ndarray) -> np.ndarray:
        block, bits = self.places(length, hashes)
        return self.blocks[block] & bits == bits


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, numbers of the words, their code points as a matrix)."""
    sizes = np.array([len(w) for w in words], np.int64)
    for length in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == length)
        if length:
            yield length, at, np.array([words[i] for i in at], f"<U{length}").view(np.uint32).reshape(len(at), length)


def terms(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summands of the polynomial hash of each word, and the powers by place."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(codes.shape[1] - 1, _P, np.uint64)]))
        return mix(codes.astype(np.uint64) + _U(1)) * powers, powers


def edits(codes: np.ndarray, alphabet: np.ndarray, known: WordFilter) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Numbers of words and edited words that the filters know: deletions, and replacements by a smaller letter."""
    n, length = codes.shape
    shorter, same = known.shards.get(length - 1), known.shards.get(length)
    same = same if same and same[2] > 1 else None
    if not shorter and not same:
        return
    with np.errstate(over="ignore"):
        part, powers = terms(codes)
        total = part.sum(axis=1, dtype=np.uint64)
        if shorter:
            ends = np.cumsum(part, axis=1, dtype=np.uint64)
            hashes = mix(ends - part + (total[:, None] - ends) * _PINV)
            new = np.ones((n, length), bool)
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]  # of equal letters in a row the first goes
            row, place = np.nonzero(new)
            hit = known.has(length - 1, hashes[row, place])
            row, place = row[hit], place[hit]
            if len(row):
                keep = np.arange(length - 1)[None, :]
                left = np.take_along_axis(codes[row], keep + (keep >= place[:, None]), axis=1)
                yield row, np.ascontiguousarray(left).view(f"<U{length - 1}").ravel().tolist()
        if same:
            rest = total[:, None] - part
            for letter in alphabet.tolist():
                row, place = np.nonzero(codes > letter)
                value = mix(np.array([letter + 1], np.uint64))[0]
                hit = known.has(length, mix(rest[row, place] + value * powers[place]))
                row, place = row[hit], place[hit]
                if len(row):
                    changed = codes[row]
                    changed[np.arange(len(row)), place] = letter
                    yield row, changed.view(f"<U{length}").ravel().tolist()


def word_filter(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> WordFilter:
    """The filters of a table of distinct words; their chunks are filled by tasks and are all that the driver gets."""
    known = WordFilter({r["_length"]: r["n"] for r in vocab.groupBy(F.char_length("word").alias("_length")).agg(F.count(F.lit(1)).alias("n")).collect()}, filter_bytes)
    size = CHUNK_BYTES // 8

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, codes in by_length(batch.column(0).to_pylist()):
                with np.errstate(over="ignore"):
                    block, bits = known.places(length, mix(terms(codes)[0].sum(axis=1, dtype=np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(block // size), pa.array((block % size).astype(np.int32)), pa.array(bits.view(np.int64))], names=["_chunk", "_block", "_bits"])

    def fill(table: pa.Table) -> pa.Table:
        out = np.zeros(size, np.uint64)
        np.bitwise_or.at(out, table["_block"].to_numpy(), table["_bits"].to_numpy().view(np.uint64))
        return pa.table({"_chunk": table["_chunk"][:1], "_data": pa.array([out.tobytes()])})

    bits = vocab.select("word").mapInArrow(places, "_chunk long, _block int, _bits long")
    bits = bits.groupBy("_chunk", "_block").agg(F.bit_or("_bits").alias("_bits"))
    known.blocks = np.zeros(-(-known.n_blocks // size) * size, np.uint64)
    for row in bits.groupBy("_chunk").applyInArrow(fill, "_chunk long, _data binary").collect():  # at most filter_bytes
        known.blocks[row["_chunk"] * size : (row["_chunk"] + 1) * size] = np.frombuffer(row["_data"], np.uint64)
    return known


def near_words(vocab: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Rows ``word, n, near, near_n`` of a written table ``word, n`` of distinct words: each pair that differs by one edit, once."""
    letters = [r[0] for r in vocab.select(F.explode(F.array_distinct(F.split("word", "")))).distinct().collect()]  # at most as many as Unicode has
    alphabet = np.array(sorted(ord(x) for x in letters if x), np.int64)
    known = vocab.sparkSession.sparkContext.broadcast(word_filter(vocab, filter_bytes))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, at, codes in by_length(batch.column(0).to_pylist()):
                step = max(1, CELLS // length)
                for low in range(0, len(at), step):
                    rows, found = [], []
                    for row, words in edits(codes[low : low + step], alphabet, known.value):
                        rows.append(row)
                        found += words
                    if found:
                        part = batch.take(pa.array(at[low + np.concatenate(rows)]))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=["word", "n", "near"])

    asked = vocab.select("word", "n").mapInArrow(ask, "word string, n long, near string")
    return asked.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def roots(forms: DataFrame, most: int, times: int = FORM_TIMES, least: int = LEAST_COUNT) -> DataFrame:
    """``word, root`` of a table ``word, form``: the end of the chain of forms.

    A form is ``times`` as frequent as its word, so a chain has at most log(most / least)
    steps, and pointers that double need the logarithm of that many rounds.
    """
    at = written(forms.select("word", F.col("form").alias("root")))
    steps, reach = 0, most // least
    while reach >= times:
        steps, reach = steps + 1, reach // times
    for _ in range(max(0, steps - 1).bit_length()):
        further = at.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        at = written(at.join(further, "root", "left").select("word", F.coalesce("_further", "root").alias("root")))
    return at


def spelling_variants(words: DataFrame, least_count: int = LEAST_COUNT, times: int = FORM_TIMES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of at least ``least_count`` occurrences.

    ``words`` has a row ``word`` for each occurrence; nulls and empty words are left out.
    Two words are near if they differ by one inserted, deleted or replaced code point.
    ``form`` is the near word of largest count (ties: the smallest in code-point order) if it
    has ``times`` the count or more, else null, as is ``form_n``; ``root`` follows forms to
    the last; ``n_near`` counts the near words.  Counting pre-aggregates, so a frequent word
    is one row a task.  An empty table gives no rows.
    """
    counted = words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocab = written(counted.filter(F.col("n") >= least_count))
    pairs = near_words(vocab, filter_bytes)
    sides = F.explode(F.array(F.struct(F.col("word"), F.col("n"), F.col("near"), F.col("near_n")), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    sides = pairs.select(sides.alias("_p")).select("_p.*")
    form = F.when(F.col("near_n") >= times * F.col("n"), F.struct((-F.col("near_n")).alias("key"), F.col("near").alias("form")))
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(form).alias("_best"))
    out = written(vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("_best.form").alias("form"), (-F.col("_best.key")).alias("form_n")))
    most = out.agg(F.max("n")).first()[0] or 0
    chained = out.join(roots(out.filter("form IS NOT NULL"), most, times, max(1, least_count)), "word", "left")
    return chained.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

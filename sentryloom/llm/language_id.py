"""Language of code-switched text by a linear-chain conditional random field.

Every word of a text gets a label.  A word's emission scores sum learned weights of its
affixes, character n-grams and lexicon marks; transition weights are learned with them.
Marginals come from forward-backward over chains of at most ``CHAIN`` words, and a text's
language is the label with the largest mean marginal over its words with letters.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._spark import append_columns, renamed_apart, small, written
from ._words import WordTable, lowered

#: Words of a chain; one transition in so many is not used.
CHAIN = 64
HASH_BITS = 16
#: Labelled rows that the model is fitted on, for each language: those with the smallest hash of their id.
ROWS_PER_LANGUAGE = 300
#: Words of each of those rows that enter training chains: consecutive, from a place that the id's hash decides.
WORDS_PER_ROW = 256
LEXICON_WORDS = 500
EPOCHS = 30


def _core(word: str) -> str:
    """The word without what is no letter at its ends."""
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b]


def features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed features of a word: prefixes and suffixes, trigrams with ends marked, lexicon marks."""
    core = _core(word)
    if not core:
        return []
    marked = f"^{core}$"
    names = [f"<{core[:n]}" for n in (1, 2, 3)] + [f">{core[-n:]}" for n in (1, 2, 3)] + [marked[i : i + 3] for i in range(len(marked) - 2)]
    if core in lexicon:
        names.append(f"={lexicon[core]}")
    return [zlib.crc32(x.encode("utf-8", "replace")) & ((1 << HASH_BITS) - 1) for x in names]


def forward_backward(emission: np.ndarray, transition: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals [chain, place, label], expected transitions [label, label] and log normaliser [chain].

    ``emission`` holds log scores [chain, place, label] and ``real`` says which places a
    chain has; places after its end pass the sums on unchanged and count for nothing.
    """
    n, length, _ = emission.shape
    high = emission.max(axis=2, keepdims=True)
    e, t = np.exp(emission - high), np.exp(transition)
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.ones((n, length), e.dtype)
    for i in range(length):
        a = e[:, i] if i == 0 else np.where(real[:, i, None], (alpha[:, i - 1] @ t) * e[:, i], alpha[:, i - 1])
        scale[:, i] = a.sum(axis=1)
        alpha[:, i] = a / scale[:, i, None]
    for i in range(length - 2, -1, -1):
        step = ((e[:, i + 1] * beta[:, i + 1]) @ t.T) / scale[:, i + 1, None]
        beta[:, i] = np.where(real[:, i + 1, None], step, beta[:, i + 1])
    right = np.where(real[:, 1:, None], e[:, 1:] * beta[:, 1:] / scale[:, 1:, None], 0)
    expected = np.einsum("nij,nik->jk", alpha[:, :-1], right) * t
    return alpha * beta, expected, np.log(scale).sum(axis=1) + np.where(real, high[:, :, 0], 0).sum(axis=1)


class Model:
    def __init__(self, languages: list[str], lexicon: dict[str, int], weights: np.ndarray, transition: np.ndarray, chain: int = CHAIN) -> None:
        self.languages, self.lexicon, self.weights, self.transition, self.chain = languages, lexicon, weights, transition, chain

    def emissions(self, words: list[str]) -> np.ndarray:
        """One row a word: log scores of the labels, then 1 if the word has a letter."""
        found = [features(w, self.lexicon) for w in words]
        sizes = np.array([len(x) for x in found], np.int64)
        out = np.zeros((len(words), len(self.languages) + 1), np.float32)
        flat = np.array([i for x in found for i in x], np.int64)
        sums = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(self.weights[flat], axis=0, dtype=np.float64)])
        ends = np.cumsum(sizes)
        out[:, :-1] = sums[ends] - sums[ends - sizes]
        out[:, -1] = sizes > 0
        return out

    def predict(self, table: WordTable, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean marginals [text, label] over words with letters, and the number of those words."""
        means, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for first, count, rows, bounds in table.described(texts):
            sizes = np.diff(bounds)
            chains = -(-sizes // self.chain)
            owner = np.repeat(np.arange(count), sizes)
            place = np.arange(len(rows)) - np.repeat(bounds[:-1], sizes)
            chain = np.repeat(np.cumsum(chains) - chains, sizes) + place // self.chain
            grid = np.zeros((int(chains.sum()), self.chain, len(self.languages)), np.float32)
            real = np.zeros(grid.shape[:2], bool)
            grid[chain, place % self.chain], real[chain, place % self.chain] = rows[:, :-1], True
            marginal = forward_backward(grid, self.transition, real)[0][chain, place % self.chain] * rows[:, -1:]
            for k in range(len(self.languages)):
                means[first : first + count, k] = np.bincount(owner, marginal[:, k], count)
            letters[first : first + count] = np.bincount(owner, rows[:, -1], count)
        return means / np.maximum(letters, 1)[:, None], letters


def _chains(samples: list[list[list[str]]], rng: np.random.Generator, chain: int = CHAIN) -> tuple[list[list[str]], np.ndarray]:
    """Training chains and labels: runs of words spliced from texts, a third of them across languages."""
    words, labels = [], []
    for k, texts in enumerate(samples):
        for text in texts:
            for i in range(0, len(text), chain):
                run, names = text[i : i + chain], [k] * len(text[i : i + chain])
                if rng.random() < 1 / 3 and len(samples) > 1:
                    other = int((k + rng.integers(1, len(samples))) % len(samples))
                    if samples[other]:
                        guest = samples[other][rng.integers(len(samples[other]))]
                        cut, at = int(rng.integers(1, len(run) + 1)), int(rng.integers(len(guest)))
                        part = guest[at : at + len(run) - cut]
                        run, names = run[:cut] + part, names[:cut] + [other] * len(part)
                words.append(run)
                labels.append(names)
    mask = np.full((len(words), chain), -1)
    for i, x in enumerate(labels):
        mask[i, : len(x)] = x
    return words, mask


def fit(samples: dict[str, list[str]], epochs: int = EPOCHS, seed: int = 5, lexicon_words: int = LEXICON_WORDS, chain: int = CHAIN) -> Model:
    """Penalised maximum likelihood by Adam from lower-cased words, separated by blanks, by language; the same input gives the same model."""
    rng = np.random.Generator(np.random.PCG64(seed))
    languages = sorted(samples)
    texts = [[t.split(" ") for t in sorted(samples[name]) if t] for name in languages]
    counts = [Counter(_core(w) for t in x for w in t) for x in texts]
    total = sum(counts, Counter())
    lexicon = {w: k for k, c in enumerate(counts) for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:lexicon_words] if w and n >= 0.8 * total[w] and n > 2}
    chains, labels = _chains(texts, rng, chain)
    number: dict[str, int] = {}
    ids = np.full(labels.shape, 0)
    for i, run in enumerate(chains):
        ids[i, : len(run)] = [number.setdefault(w, len(number)) for w in run]
    found = [features(w, lexicon) for w in number]
    flat = np.array([f for x in found for f in x], np.int64)
    word_of = np.repeat(np.arange(len(found)), [len(x) for x in found])
    k = len(languages)
    weights, transition = np.zeros((1 << HASH_BITS, k)), np.zeros((k, k))
    real = labels >= 0
    pairs = real[:, 1:] & real[:, :-1]
    seen = np.zeros((k, k))
    np.add.at(seen, (labels[:, :-1][pairs], labels[:, 1:][pairs]), 1.0)
    places = max(1, int(real.sum()))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (weights, transition)]
    for step in range(1, epochs + 1):
        scores = np.stack([np.bincount(word_of, weights[flat, j], len(found)) for j in range(k)], axis=1) if len(found) else np.zeros((1, k))
        emission = np.where(real[:, :, None], scores[ids], 0.0)
        marginal, expected, _ = forward_backward(emission, transition, real)
        gold = np.where(real[:, :, None], np.eye(k)[np.maximum(labels, 0)] - marginal, 0.0)
        by_word = np.stack([np.bincount(ids.ravel(), gold[:, :, j].ravel(), max(1, len(found))) for j in range(k)], axis=1)
        slope = np.stack([np.bincount(flat, by_word[word_of, j], 1 << HASH_BITS) for j in range(k)], axis=1)
        for p, g, (m, v) in zip((weights, transition), (slope / places - 1e-6 * weights, (seen - expected) / places - 1e-4 * transition), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(languages, lexicon, weights.astype(np.float32), transition.astype(np.float32), chain)


def sample_rows(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, words_per_row: int) -> dict[str, list[str]]:
    """``words_per_row`` consecutive words of at most ``per_language`` rows for each language, those with the smallest hash of the id.

    The words are cut out where the text is read: what the driver gets is bounded by both parameters, not by the length of texts.
    """
    ids = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(lang_col, id_col, F.xxhash64(F.lit(3), id_col).alias("_h"))
    # First by a bound on the hash that leaves a few more than enough, so that no task ranks all rows of a language.
    counts = small(written(ids.groupBy(lang_col).agg(F.count(F.lit(1)).alias("_all"))))
    share = F.least(F.lit(1.0), F.lit(per_language + 12 * per_language**0.5 + 50.0) / F.col("_all"))
    near = ids.join(counts, lang_col).filter(F.shiftrightunsigned("_h", 11) < share * float(1 << 53))
    order = (F.shiftrightunsigned("_h", 1), F.col("_h"), F.col(id_col))
    picked = near.withColumn("_n", F.row_number().over(Window.partitionBy(lang_col).orderBy(*order))).filter(F.col("_n") <= per_language).select(id_col)
    rows = labelled.join(F.broadcast(picked.distinct()), id_col, "left_semi").select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text in batch.column(1).to_pylist():
                words = lowered(text).split()
                at = zlib.crc32((text or "").encode("utf-8", "replace")) % max(1, len(words) - words_per_row + 1)
                parts.append(b" ".join(words[at : at + words_per_row]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.string())], names=["lang", "words"])

    out: dict[str, list[str]] = {}
    for lang, words in rows.mapInArrow(cut, "lang string, words string").toLocalIterator():
        if lang is not None and words:
            out.setdefault(lang, []).append(words)
    return out


def identify_language(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = ROWS_PER_LANGUAGE, words_per_row: int = WORDS_PER_ROW, lexicon_words: int = LEXICON_WORDS, chain: int = CHAIN) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred, score``.

    The model learns from at most ``per_language`` rows of ``labelled`` for each non-null
    language, ``words_per_row`` consecutive words of each, with a lexicon of at most
    ``lexicon_words`` words a language (they bound the fit on the driver, nothing else), and
    predicts from the whole text alone, in chains of ``chain`` words: between two chains no
    transition is used.  ``score`` is the mean marginal of the
    predicted label (ties: the first language in code point order).  A null text, or one
    without any letter, gets ``und`` and score 0, as does every text if there is nothing to
    learn from.  Texts of any length are labelled whole, repeated rows alike; an empty table
    gives an empty result; ids and other columns pass unchanged; input columns named like the outputs are replaced.
    """
    docs = renamed_apart(docs, ["lang_pred", "score"])
    samples = sample_rows(labelled, id_col, text_col, lang_col, per_language, words_per_row)
    if not samples:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    model = fit(samples, lexicon_words=lexicon_words, chain=chain)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.lexicon, model.weights, model.transition, model.chain))

    def start() -> Callable[[list], list[pa.Array]]:
        local = Model(*shared.value)
        table = WordTable(local.emissions)
        names = np.array(local.languages, object)

        def predict(texts: list[str | None]) -> list[pa.Array]:
            means, letters = local.predict(table, texts)
            best = means.argmax(axis=1)
            score = np.clip(means[np.arange(len(best)), best], 0, 1)
            return [pa.array(np.where(letters > 0, names[best], "und"), pa.string()), pa.array(np.where(letters > 0, score, 0.0))]

        return predict

    return append_columns(docs, text_col, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], start)


def fold(id_col: str, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % folds

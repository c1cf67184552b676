"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed word and word-prefix features is trained in numpy from
texts confirmed toxic and from unlabelled texts.  The risk of the unlabelled texts is
corrected by the class prior, and its negative part is held at zero from below, so the
classifier does not learn unlabelled toxic texts as clean ones.  Of the hashed features
those enter whose rates in toxic and in clean texts differ clearly, either way; the rate in
clean texts is the rate in unlabelled ones corrected by the same prior.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._spark import append_columns, renamed_apart, written
from ._words import WordTable

HASH_BITS = 20
#: Letters of the word prefixes that are features beside the whole word.
PREFIXES = (3, 4, 5, 6)
#: Texts that the classifier is fitted on: confirmed toxic and unlabelled ones with the smallest hash of the id.
POSITIVES, UNLABELLED = 4000, 8000
#: Standard errors by which a feature's rates in toxic and clean texts must differ for it to enter the classifier.
SCREEN = 3.0
#: Features of the classifier at most, the strongest first.
FEATURES = 20_000
#: A feature is in at least so many of the texts that speak for its side (or this share of the toxic ones, if more).
LEAST_TEXTS, LEAST_SHARE = 5, 0.004
#: Full-batch steps, penalty on squared weights, and how far the negative risk may fall below zero before it is corrected.
STEPS, PENALTY, SLACK = 300, 3e-5, 0.0


def features(word: str) -> list[int]:
    """Hashes of the word without what is no letter at its ends and of its prefixes."""
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    core = word[a:b]
    names = ["=" + core] if core else []
    names += [core[:n] for n in PREFIXES if n < len(core)]
    return [zlib.crc32(x.encode("utf-8", "replace")) & ((1 << HASH_BITS) - 1) for x in names]


def _hashed(words: list[str]) -> np.ndarray:
    out = np.full((len(words), 1 + len(PREFIXES)), -1, np.int32)
    for row, word in zip(out, words, strict=True):
        found = features(word)
        row[: len(found)] = found
    return out


def text_features(table: WordTable, texts: list[str | None]) -> Iterator[np.ndarray]:
    """The distinct features of each text, in order."""
    for _, count, rows, bounds in table.described(texts):
        for i in range(count):
            found = np.unique(rows[bounds[i] : bounds[i + 1]])
            yield found[found >= 0]


def prior_corrected_risk(scores: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """Positive risk, negative risk and the slope of the non-negative risk in each score.

    Logistic loss.  Where the estimated negative risk is below zero the step goes up its
    slope instead, which is the published correction against overfitting.
    """
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    as_positive, as_negative = np.logaddexp(0, -scores), np.logaddexp(0, scores)
    p = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
    risk_p = prior * as_positive[positive].sum() / n_p
    risk_n = as_negative[~positive].sum() / n_u - prior * as_negative[positive].sum() / n_p
    up = np.where(positive, prior * (p - 1) / n_p, 0.0)
    down = np.where(positive, -prior * p / n_p, p / n_u)
    return float(risk_p), float(risk_n), up + down if risk_n >= -SLACK else -down


def screened(texts_with: np.ndarray, n_u: int, n_p: int, prior: float, screen: float, most: int, least_texts: int, least_share: float) -> np.ndarray:
    """Features, by hash, whose rates in toxic and in clean texts differ by ``screen`` standard errors.

    ``texts_with`` counts [unlabelled, toxic] texts with each feature.  Unlabelled texts are
    toxic with the prior's chance, so the rate in clean texts is (u - prior * p) / (1 - prior).
    """
    p, u = (texts_with[1] + 0.5) / (n_p + 1), (texts_with[0] + 0.5) / (n_u + 1)
    clean = np.maximum((u - prior * p) / (1 - prior), 0.5 / (n_u + 1))
    pooled = np.minimum((p * n_p + clean * n_u) / (n_p + n_u), 0.5)
    z = (p - clean) / np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))
    z[np.where(z > 0, texts_with[1], texts_with[0]) < max(least_texts, least_share * n_p)] = 0
    picked = np.argsort(-np.abs(z), kind="stable")[:most]
    return np.sort(picked[np.abs(z[picked]) >= max(screen, 1e-9)])


def fit(kept: list[np.ndarray], positive: np.ndarray, prior: float, columns: int) -> tuple[np.ndarray, float]:
    """Weights by column and bias from the columns of each text; the same rows give the same classifier."""
    prior = min(max(prior, 1e-3), 0.9)
    bias = float(np.log(prior / (1 - prior)))
    if not positive.any() or positive.all():
        return np.zeros(columns), -5.0 if not positive.any() else bias
    w, b = np.zeros(columns), bias
    lengths = np.array([len(x) for x in kept])
    owner, flat = np.repeat(np.arange(len(kept)), lengths), np.concatenate(kept)
    moments = [np.zeros(columns), np.zeros(columns), 0.0, 0.0]
    for step in range(1, STEPS + 1):
        scores = np.bincount(owner, w[flat], len(kept)) + b
        _, _, slope = prior_corrected_risk(scores, positive, prior)
        g_w, g_b = np.bincount(flat, slope[owner], len(w)) + PENALTY * w, slope.sum()
        moments[0] = 0.9 * moments[0] + 0.1 * g_w
        moments[1] = 0.999 * moments[1] + 0.001 * g_w * g_w
        moments[2] = 0.9 * moments[2] + 0.1 * g_b
        moments[3] = 0.999 * moments[3] + 0.001 * g_b * g_b
        fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.05 * (moments[0] / fix1) / (np.sqrt(moments[1] / fix2) + 1e-8)
        b -= 0.05 * (moments[2] / fix1) / (np.sqrt(moments[3] / fix2) + 1e-8)
    # The clamp leaves the level of the scores open: set the bias so that the unlabelled texts score the prior on average.
    free = np.bincount(owner, w[flat], len(kept))[~positive]
    low, high = -20.0, 20.0
    for _ in range(60):
        b = (low + high) / 2
        low, high = (b, high) if np.mean(1 / (1 + np.exp(-np.clip(free + b, -30, 30)))) < prior else (low, b)
    return w, float(b)


def _smallest(ids: DataFrame, id_col: str, n: int) -> DataFrame:
    """Ids alone, so that no text moves: the n with the smallest hash."""
    return ids.select(id_col).distinct().withColumn("_h", F.xxhash64(F.lit(7), id_col)).orderBy("_h", id_col).limit(n).select(id_col)


def score_toxicity(docs: DataFrame, texts: DataFrame, labels: DataFrame, threshold: float = 0.3, prior: float | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED, screen: float = SCREEN, most_features: int = FEATURES, least_texts: int = LEAST_TEXTS, least_share: float = LEAST_SHARE) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``).

    ``texts`` has the ids and texts to learn from, ``labels`` ids and labels: rows of label 1
    are the confirmed toxic ones and, unless ``prior`` is given, the share of label 1 is the
    class prior.  Other labels are not learned from; all of ``texts`` count as unlabelled.
    The fit is bounded: at most ``positives`` and ``unlabelled`` texts (only those are moved),
    and at most ``most_features`` of the features whose rates in toxic and clean texts differ by
    ``screen`` standard errors (0: any difference) and that ``least_texts`` texts have, or
    ``least_share`` of the number of toxic ones.  The driver gets the counts of features and,
    of each text, the features that entered.  Null
    and empty texts have no features and get the bias alone; a text of any length is scored
    whole; repeated rows score alike; an empty table gives an empty result; ids and other
    columns pass unchanged; input columns named like the outputs are replaced.  Without confirmed examples every score is low.
    """
    docs = renamed_apart(docs, ["score", "predicted"])
    known = labels.filter(F.col(label_col).isNotNull())
    if prior is None:
        prior = known.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0
    positive = _smallest(known.filter(F.col(label_col) == 1), id_col, positives).withColumn("_y", F.lit(1))
    free = _smallest(texts, id_col, unlabelled).withColumn("_y", F.lit(0))
    picked = texts.select(id_col, text_col).join(F.broadcast(positive.unionByName(free)), id_col)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(_hashed)
        for batch in batches:
            rows = [x.astype("<i4").tobytes() for x in text_features(table, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["_y", "_h", "_f"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, 1 << HASH_BITS), np.int64)
        for batch in batches:
            for y, found in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                sums[y][np.frombuffer(found, "<i4")] += 1
                sums[2][y] += 1
        some = np.flatnonzero(sums[0] + sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), *[pa.array(np.append(sums[y][some], sums[2][y])) for y in (0, 1)]], names=["_f", "_u", "_p"])

    both = picked.withColumn("_h", F.xxhash64(F.lit(7), id_col)).select("_y", "_h", text_col)
    sample = written(both.mapInArrow(extract, "_y int, _h long, _f binary"))
    counts = sample.mapInArrow(count, "_f long, _u long, _p long").groupBy("_f").agg(F.sum("_u").alias("_u"), F.sum("_p").alias("_p")).toArrow()  # at most 2^HASH_BITS rows
    at, with_it = counts["_f"].to_numpy(), np.stack([counts["_u"].to_numpy(), counts["_p"].to_numpy()])
    n_u, n_p = (int(x) for x in with_it[:, at < 0].sum(axis=1))
    texts_with = np.zeros((2, 1 << HASH_BITS))
    texts_with[:, at[at >= 0]] = with_it[:, at >= 0]
    chosen = screened(texts_with, n_u, n_p, min(max(prior, 1e-3), 0.9), screen, most_features, least_texts, least_share) if n_u and n_p else np.zeros(0, np.int64)

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.flatnonzero(np.isin(chosen, np.frombuffer(f, "<i4"))).astype("<i4").tobytes() for f in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["_y", "_h", "_f"])

    rows = sorted((r["_y"], r["_h"], bytes(r["_f"])) for r in sample.mapInArrow(columns, sample.schema).toLocalIterator())
    weights, bias = fit([np.frombuffer(x[2], "<i4") for x in rows], np.array([x[0] == 1 for x in rows], bool), prior, len(chosen))
    model = docs.sparkSession.sparkContext.broadcast((chosen, weights.astype(np.float32), bias))

    def start() -> Callable[[list], list[pa.Array]]:
        places, values, b = model.value
        column = np.full(1 << HASH_BITS, -1, np.int32)
        column[places] = np.arange(len(places))
        table = WordTable(lambda words: np.where((h := _hashed(words)) >= 0, column[h], -1).astype(np.int32))

        def score(texts: list[str | None]) -> list[pa.Array]:
            out = np.full(len(texts), b)
            for first, count, found, bounds in table.described(texts):
                owner = np.repeat(np.arange(count), np.diff(bounds))
                word, place = np.nonzero(found >= 0)
                once = np.unique(owner[word] * len(places) + found[word, place]) if len(word) else np.zeros(0, np.int64)
                if len(once):
                    out[first : first + count] += np.bincount(once // len(places), values[once % len(places)], count)
            return [pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))]

        return score

    return append_columns(docs, text_col, [T.StructField("score", T.DoubleType())], start).withColumn("predicted", (F.col("score") >= threshold).cast("int"))

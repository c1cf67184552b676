import itertools
import math
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentryloom.llm.katz import GT_MAX, RESERVE, discounts, pack_keys, score_texts, unpack_keys
from sentryloom.llm.katz import _unzip as unzip
from sentryloom.llm.katz import _zip as zip_
from sentryloom.llm.language_id import fold, forward_backward, identify_language
from sentryloom.llm.toxicity import prior_corrected_risk, score_toxicity

from .conftest import edge_rows

SF01 = "/root/testdata/sf0.01"


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(2)
    e, t = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3))
    real = np.arange(5)[None, :] < np.array([5, 3, 1])[:, None]
    marginal, expected, z = forward_backward(np.where(real[:, :, None], e, 0), t, real)
    want = np.zeros((3, 3))
    for i, n in enumerate((5, 3, 1)):
        total, place = 0.0, np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=n):
            p = math.exp(sum(e[i, k, y] for k, y in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path)))
            total += p
            for k, y in enumerate(path):
                place[k, y] += p
        for path in itertools.product(range(3), repeat=n):
            p = math.exp(sum(e[i, k, y] for k, y in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path))) / total
            for a, b in itertools.pairwise(path):
                want[a, b] += p
        assert np.allclose(marginal[i, :n], place / total) and np.isclose(z[i], math.log(total))
    assert np.allclose(expected, want)


def test_language_held_out(spark, empty):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    train = docs.filter(fold("doc_id", 3) != 1)
    rows = identify_language(docs.filter(fold("doc_id", 3) == 1), train).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 ..."), (None, "the and of that"), (4, "the and of that " * 50_000)], "doc_id long, text string").withColumn("score", F.lit("x"))
    out = {r.doc_id: r for r in identify_language(odd, train).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and out[4].lang_pred == "en" and all(0 <= r.score <= 1 for r in out.values())
    assert identify_language(empty, train).collect() == []
    assert {r.lang_pred for r in identify_language(odd, empty).collect()} == {"und"}


def test_code_switched_text_is_shared_between_its_languages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    train = docs.filter(fold("doc_id", 3) != 1)
    en, de = (train.filter((F.col("lang") == x) & (F.length("text") > 900)).orderBy("doc_id").first().text[:800] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, en + " " + de), (2, en + " " + en + " " + de)], "doc_id long, text string")
    out = {r.doc_id: r for r in identify_language(mixed, train).collect()}
    assert out[1].score < 0.75 and out[2].lang_pred == "en"


def test_toxicity_held_out(spark, empty):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    held = fold("doc_id", 4) == 2
    train, known = docs.filter(~held), labels.filter(~held)
    rows = score_toxicity(docs.filter(held).join(labels, "doc_id"), train, known).collect()
    hit = sum(r.toxic and r.predicted for r in rows)
    assert hit / sum(r.predicted for r in rows) > 0.8 and hit / sum(r.toxic for r in rows) > 0.8
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "idiot")], "doc_id long, text string").withColumn("predicted", F.lit("x"))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in score_toxicity(odd, train, known).collect())
    assert score_toxicity(empty, train, known).collect() == []
    assert all(r.predicted == 0 for r in score_toxicity(odd, train.limit(5), known.limit(0)).collect())


def test_risk_slope():
    rng = np.random.default_rng(0)
    scores, positive = rng.normal(size=12), np.arange(12) < 4
    risk = lambda s: sum(prior_corrected_risk(s, positive, 0.2)[:2])
    slope = prior_corrected_risk(scores, positive, 0.2)[2]
    step = 1e-6 * np.eye(12)
    assert np.allclose([(risk(scores + d) - risk(scores - d)) / 2e-6 for d in step], slope, atol=1e-5)
    confident = np.where(positive, 9.0, -9.0)
    assert prior_corrected_risk(confident, positive, 0.9)[1] < 0


class Katz:
    """The model of the docstring, word by word with dictionaries.  A start symbol is 0, the end None."""

    def __init__(self, texts, order, least=1):
        self.c = [Counter() for _ in range(order + 1)]
        self.order, self.least = order, least
        for t in texts:
            for g in self.grams(t):
                for n in range(1, order + 1):
                    self.c[n][g[-n:]] += 1
        self.n = sum(self.c[1].values())
        spread = lambda c: [sum(v == r for v in c.values()) for r in range(GT_MAX + 2)]
        self.d = [None, discounts(spread(self.c[1]), 1)] + [discounts(spread(c), least) for c in self.c[2:]]
        self.unk = (self.n - sum(self.events(1, c) for c in self.c[1].values())) / self.n if self.n else 1.0
        self.followers = [{} for _ in range(order + 1)]
        for n in range(2, order + 1):
            for g, c in self.c[n].items():
                if c >= least:
                    self.followers[n].setdefault(g[:-1], []).append(g[-1])

    @staticmethod
    def words(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]

    def grams(self, t):
        seq = (0,) * (self.order - 1) + tuple(self.words(t))
        return [seq[i : i + self.order] for i in range(len(seq) - self.order + 1)]

    def events(self, n, c):
        return self.d[n][c] * c if c <= GT_MAX else c - RESERVE

    def seen(self, g):
        history = self.c[1][None,] if not any(x is None or x for x in g[:-1]) else self.c[len(g) - 1][g[:-1]]
        return self.events(len(g), self.c[len(g)][g]) / history

    def p(self, g):
        c = self.c[len(g)][g]
        if len(g) == 1:
            return self.events(1, c) / self.n if c else self.unk
        if c >= self.least:
            return self.seen(g)
        return self.alpha(g[:-1]) * self.p(g[1:])

    @lru_cache(None)  # noqa: B019
    def alpha(self, h):
        f = self.followers[len(h) + 1].get(h, [])
        return (1 - sum(self.seen((*h, x)) for x in f)) / (1 - sum(self.p((*h[1:], x)) for x in f))


@pytest.mark.parametrize("order, least", [(2, 1), (3, 1), (3, 2)])
def test_katz_against_dictionaries(spark, monkeypatch, order, least):
    import sentryloom.llm.katz as module

    monkeypatch.setattr(module, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(module, "PARTITION_KEYS", 3_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("_train", fold("doc_id", 7) != 2)
    rows = docs.collect()
    model = Katz([r.text for r in rows if r._train], order, least)
    out = {r.doc_id: r for r in score_texts(docs.withColumn("score", F.lit(1)), order=order, min_count=least).collect()}
    assert len(out) == len(rows)
    for r in rows if order == 2 else rows[::4]:
        seq, g = Katz.words(r.text), out[r.doc_id]
        base = sum(math.log10((model.c[1][w,] + 1) / (model.n + len(model.c[1]) + 1)) for w in seq)
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(seq), sum(model.c[1][w,] > 0 for w in seq), model.n)
        assert g.score == pytest.approx(sum(math.log10(model.p(x)) for x in model.grams(r.text)), rel=1e-9) and g.base_score == pytest.approx(base, rel=1e-9)
    some = random.Random(1).sample(sorted((g[:-1] for g in model.c[order] if None not in g[:-1]), key=repr), 20)
    for h in [(0,) * (order - 1), *some]:
        assert sum(model.p((*h, *v)) for v in model.c[1]) + model.p((*h, "no such word")) == pytest.approx(1, abs=1e-9)
    held = [out[r.doc_id] for r in rows if not r._train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_katz_tells_copies_of_training_texts_apart(spark):
    """Held-out texts with one copy among the training texts score higher a token than those without."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").withColumn("_train", fold("doc_id", 7) != 2)
    known = {r.text for r in docs.filter("_train").collect()}
    text = {r.doc_id: r.text for r in docs.filter("NOT _train").collect()}
    copies, others = [], []
    for r in score_texts(docs).filter("NOT _train").collect():
        (copies if text[r.doc_id] in known else others).append(r.score / r.n_tokens)
    cut = sorted(others)[int(0.9 * len(others))]
    assert sum(x > cut for x in copies) / len(copies) > 0.8


def test_katz_reads_every_id_type_and_large_ids(spark):
    rows = score_texts(spark.createDataFrame([("x", "a b", True), (None, "a", False)], "doc_id string, text string, _train boolean")).collect()
    assert {r.doc_id for r in rows} == {"x", None} and all(r.train_tokens == 3 for r in rows)
    big = (1 << 62) + 1
    assert {r.doc_id for r in score_texts(spark.createDataFrame([(big, "a", True), (None, "b", True)], "doc_id long, text string, _train boolean")).collect()} == {big, None}
    assert unzip(zip_(np.array([1, 1 << 40]))).tolist() == [1, 1 << 40]


def test_katz_edge_cases(edge, empty):
    rows = score_texts(edge.withColumn("_train", F.lit(True))).collect()
    assert len(rows) == len(edge_rows())
    assert all(r.n_tokens == len(Katz.words(t)) for r, t in zip(sorted(rows, key=lambda r: (repr(r.doc_id), r.n_tokens)), (t for _, t, *_ in sorted(edge_rows(), key=lambda x: (repr(x[0]), len(Katz.words(x[1]))))), strict=True))
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in score_texts(edge.withColumn("_train", F.lit(None).cast("boolean"))).collect())
    assert score_texts(empty.withColumn("_train", F.lit(True))).collect() == []


def test_packed_keys_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        for top in (1 << 63, 1 << 40):
            keys = np.unique(rng.integers(0, top, n, dtype=np.uint64))
            assert (unpack_keys(pack_keys(keys)) == keys).all()
    assert zlib.crc32(b"1") % 3 in (0, 1, 2)

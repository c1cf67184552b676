"""Input columns named like internal ones, and ids that are texts, for every operator."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentryloom.llm.collocations import collocations
from sentryloom.llm.decontamination import contained_items, decontaminate
from sentryloom.llm.exact_dedup import exact_dedup
from sentryloom.llm.katz import score_texts
from sentryloom.llm.language_id import identify_language
from sentryloom.llm.min_slack import pack_min_slack
from sentryloom.llm.mixing import mix_sources, mixed_documents
from sentryloom.llm.near_dedup import near_duplicates, one_of_each_group
from sentryloom.llm.packing import pack_tokens
from sentryloom.llm.sharding import shard_rows
from sentryloom.llm.spelling import document_words, spelling_variants
from sentryloom.llm.token_counts import count_tokens
from sentryloom.llm.toxicity import score_toxicity

from .conftest import words

ODD = ("_n", "_p", "_b", "_k", "_hot", "_x", "_h", "_v", "_id", "_text", "_kind", "_offset", "_times")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def rows(spark, text_ids):
    rng = random.Random(12)
    base = words(rng, 30)
    texts = [base, base + " more", base, None, "", words(rng, 8), words(rng, 300)]
    data = [(f"id{i}" if text_ids else i, t, "en" if i % 2 else "de", f"s{i % 2}") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, f"doc_id {'string' if text_ids else 'long'}, text string, lang string, source string")


def operators(spark):
    labels = lambda d: d.select("doc_id", F.when(F.col("text").contains("more"), 1).otherwise(0).alias("toxic"))
    items = spark.createDataFrame([(1, words(random.Random(12), 30))], "item_id long, text string")
    return {
        "near": (near_duplicates, False), "one": (one_of_each_group, True), "count": (lambda d: count_tokens(d, PATH), True), "contained": (lambda d: contained_items(d, items), False), "clean": (lambda d: decontaminate(d, items), True),
        "exact": (exact_dedup, True), "language": (lambda d: identify_language(d, d), True), "mix": (mix_sources, True), "mixed": (mixed_documents, True), "toxic": (lambda d: score_toxicity(d, d, labels(d)), True),
        "katz": (lambda d: score_texts(d.withColumn("_train", F.lit(True))), False), "shard": (lambda d: shard_rows(d, 3), True), "pack": (lambda d: pack_tokens(d, PATH, width=64), False),
        "slack": (lambda d: pack_min_slack(d.coalesce(1), PATH, 64), False), "spelling": (lambda d: spelling_variants(document_words(d)), False), "phrases": (lambda d: collocations(d, min_count=2), False),
    }


NAMES = ("near", "one", "count", "contained", "clean", "exact", "language", "mix", "mixed", "toxic", "katz", "shard", "pack", "slack", "spelling", "phrases")


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns_and_text_ids(spark, name):
    """The same result with clashing columns as without, and those columns unchanged where the operator keeps columns."""
    call, keeps = operators(spark)[name]
    for text_ids in (False, True):
        plain = rows(spark, text_ids)
        odd = plain.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in ODD])
        want, out = call(plain), call(odd)
        got = out.collect()
        if keeps:
            assert all(r[c] == c + str(r.doc_id) for r in got for c in ODD)
        assert sorted(repr([r[c] for c in want.columns]) for r in got) == sorted(repr([r[c] for c in want.columns]) for r in want.collect())


BIG = (1 << 60) + 1


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("spelling", "phrases")])
def test_large_ids_and_columns_beside_nulls(spark, name):
    """Ids and carried columns over 2^53 stay as they are when a null stands in the same batch."""
    call, keeps = operators(spark)[name]
    base = words(random.Random(12), 30)
    data = [(BIG, base, "en", "s0", None), (None, base + " more", "de", "s1", BIG + 2), (BIG + 4, "eins zwei drei vier fünf sechs", "de", "s1", BIG + 6)]
    out = call(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, other long").coalesce(1)).collect()
    ids = {i for r in out for i in (r.doc_ids if name == "pack" else [r.doc_id])}
    assert ids <= {BIG, None, BIG + 4} and (name in ("one", "clean", "contained", "mixed") or len(ids) == 3)
    if keeps:
        assert {(r.doc_id, r.other) for r in out} <= {(i, o) for i, *_, o in data}

"""Fingerprints, pages and Bloom filters against plain definitions."""

from __future__ import annotations

from pyspark.sql import functions as F
from sentryloom.operators import content as C
from sentryloom.operators import records
from sentryloom.operators import similarity as S
from sentryloom.plans.catalog import QUERIES


def grams(t):
    low = " ".join(t.lower().split())
    return {low[i : i + 3] for i in range(len(low) - 2)}


def test_minhash_estimates_jaccard_and_equal_texts_agree(spark):
    texts = {1: "the quick brown fox jumps over the lazy dog", 2: "the quick brown fox jumped over a lazy dog", 3: "The quick  brown fox jumps over the lazy dog", 4: "nothing like it at all, really"}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    sig = {r.id: r.signature for r in S.minhash(df, "id", "text").collect()}
    share = lambda a, b: sum(x == y for x, y in zip(sig[a], sig[b], strict=True)) / 128
    assert share(1, 3) == 1
    for a, b in ((1, 2), (1, 4), (2, 4)):
        exact = len(grams(texts[a]) & grams(texts[b])) / len(grams(texts[a]) | grams(texts[b]))
        assert abs(share(a, b) - exact) < 0.18
    fp = S.minhash(df, "id", "text").join(S.simhash(df, "id", "text"), "id")
    assert {(r.a, r.b) for r in S.similar_pairs(fp, "id", 0.9).collect()} == {(1, 3)}
    flags = {r.id: r.duplicate for r in records.duplicate_flag(fp.filter("id > 2"), fp.filter("id <= 2"), "id", 0.9).collect()}
    assert flags == {3: True, 4: False}
    assert {(r.kind, r.fingerprints) for r in S.similarity_stats(fp, "id").collect()} == {("minhash", 4), ("simhash", 4)}


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    m, k = S.bloom_size(2000, 0.01)
    assert m % 8 == 0 and k == 6
    bloom = S.bloom_build(spark.range(2000).select(F.concat(F.lit("u"), "id").alias("u")), "u", m, k)
    asked = spark.range(6000).select("id", F.concat(F.lit("u"), "id").alias("u"))
    out = {r.id: r.maybe for r in S.bloom_contains(asked, bloom, "u", "id", m, k).collect()}
    assert all(out[i] for i in range(2000)) and sum(out[i] for i in range(2000, 6000)) < 120
    stats = S.bloom_stats(bloom, m, k).first()
    assert 0.4 < stats.fill < 0.6 and stats.fpp < 0.05


def test_bloom_queries_are_sized_for_the_table(spark, tmp_path):
    pages = spark.range(300_000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://a.example/"), "id").alias("url"))
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    stats = QUERIES["bloom_stats"](spark, str(tmp_path)).first()
    assert 0.4 < stats.fill < 0.6 and stats.fpp < 0.02
    wrong = F.sum((F.col("maybe") != (F.col("page_id") % 2 == 0)).cast("int"))
    missed = F.sum((~F.col("maybe") & (F.col("page_id") % 2 == 0)).cast("int"))
    probe = QUERIES["bloom_probe"](spark, str(tmp_path)).agg(F.count(F.lit(1)).alias("n"), missed.alias("missed"), wrong.alias("wrong")).first()
    assert probe.n == 300_000 and probe.missed == 0 and probe.wrong < 0.02 * 150_000


def test_exact_copies_keep_their_links(spark, tmp_path):
    text = "the quick brown fox jumps over the lazy dog"
    texts = {1: text, 2: "nothing like it at all, really", 5: text, 6: text, 7: text.replace("quick ", "quick  "), 10: "a b", 11: "a b", 15: None, 20: "alone with these words"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    flags = {r.doc_id: (r.duplicate, r.matches, r.best) for r in QUERIES["duplicate_flag"](spark, str(tmp_path)).collect()}
    assert flags == {5: (True, 3, 1.0), 10: (True, 1, 1.0), 15: (False, 0, 0.0), 20: (False, 0, 0.0)}
    pairs = {(r.a, r.b) for r in QUERIES["similar_pairs"](spark, str(tmp_path)).collect()}
    assert pairs == {(1, 5), (1, 6), (1, 7), (10, 11)}


def test_pages_become_sections_in_order(spark):
    html = "<html><title>A &amp; B</title><script>var p='<p>no</p>'</script><nav><li>menu</li></nav><article><h1>Head</h1><p>One <b>two</b></p><ul><li>x</li></ul><blockquote>q</blockquote></article></html>"
    rows = C.parse_pages(spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id long, html string")).collect()
    assert [(r.kind, r.level, r.content, r.in_article) for r in rows] == [("headline", 1, "Head", True), ("paragraph", 0, "One two", True), ("list", 0, "x", True), ("quote", 0, "q", True)]
    assert {r.title for r in rows} == {"A & B"}


def test_keywords_do_not_begin_as_others_end():
    words = [w.split() for ws in C.SUBJECTS.values() for w in ws]
    assert not [(a, b) for a in words for b in words for n in range(1, min(len(a), len(b))) if a[-n:] == b[:n] and a != b and len(a) > n]


def test_shingles_and_trigrams_are_all_there(spark):
    """Against a loop over characters, with characters beyond 16 bits, short and empty texts."""
    texts = ["", "ab", "abc", "a😀b😀c", "Ünï  \t çödé x", "aaaa"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in df.select("t", S.char_shingles(F.col("t")).alias("s")).collect():
        low = " ".join(r.t.lower().split())
        assert set(r.s) == ({low[i : i + 3] for i in range(len(low) - 2)} if len(low) >= 3 else {low})
    got = sorted((r.id, r.gram) for r in C.trigrams(df, "t", "id").collect())
    assert got == sorted((i, t.lower()[j : j + 3]) for i, t in enumerate(texts) for j in range(len(t) - 2))

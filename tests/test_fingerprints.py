"""Fingerprints are added up where texts are read, and give what Spark's own hash functions give."""

import hashlib

from pyspark.sql import functions as F
from sentryloom.operators import content as C
from sentryloom.operators import similarity as S

TEXTS = [(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "ab"), (5, "Ünï  \t çödé 😀😀 words words words"), (6, "x y " * 400), (1, "a second row of one key")]


def physical(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_minhash_is_the_least_of_sparks_hashes(spark, monkeypatch):
    monkeypatch.setattr(S, "HASHES_AT_ONCE", 50)
    df = spark.createDataFrame(TEXTS, "id long, text string").coalesce(1)
    got = {r.id: r.signature for r in S.minhash(df, "id", "text").collect()}
    rows = df.select("id", F.explode(S.char_shingles(F.col("text"))).alias("g")).select("id", F.xxhash64("g").alias("h"))
    want = rows.groupBy("id").agg(F.array(*[F.min(F.xxhash64("h", F.lit(i))) for i in range(128)]).alias("s"))
    assert got == {r.id: r.s for r in want.collect()} and len(got) == 6
    assert "Generate" not in physical(S.minhash(df, "id", "text"))  # shingles are no rows


def test_simhash_counts_votes_without_rows_of_words(spark):
    df = spark.createDataFrame(TEXTS, "id long, text string")
    got = S.simhash(df, "id", "text")
    # A sum by key alone: the words of a text are not grouped by themselves first.
    assert "_w" not in "".join(x for x in physical(got).splitlines() if "Aggregate" in x)
    for r in got.filter("id <> 1").collect():
        words = [w for w in (dict(TEXTS[1:6])[r.id] or "").lower().split() if len(w) > 2]
        hashes = [int(hashlib.md5(w.encode()).hexdigest()[:16], 16) for w in words]
        bits = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
        assert r.simhash & (1 << 64) - 1 == bits


def test_sections_go_back_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_CHARS", 30)
    real = C.pa.RecordBatch.from_arrays

    class Frame:
        schema = spark.createDataFrame([(1, "x")], "page_id long, html string").schema

        def select(self, *_):
            return self

        def mapInArrow(self, parse, _):
            batch = real([C.pa.array(range(6)), C.pa.array(["<p>one</p><p>two</p>"] * 5 + [None])], names=["page_id", "html"])
            return [r for b in parse(iter([batch])) for r in b.to_pylist()]

    rows = C.parse_pages(Frame())
    monkeypatch.undo()
    assert [(r["page_id"], r["content"]) for r in rows] == [(i, x) for i in range(5) for x in ("one", "two")]
    batch = real([C.pa.array(range(6)), C.pa.array(["<p>one</p>"] * 6)], names=["page_id", "html"])
    monkeypatch.setattr(C, "CHUNK_CHARS", 15)
    pieces = []

    class Again(Frame):
        def mapInArrow(self, parse, _):
            pieces.extend(b.num_rows for b in parse(iter([batch])))

    C.parse_pages(Again())
    assert pieces == [2, 2, 2]

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from sentryloom.llm.queries import OP12_SQL, op12_spelling_variants
from sentryloom.llm.spelling import document_words, misspelt, near_words, spelling_variants

SF = "/root/testdata/sf0.001"


def lowered(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def word_of(doc, run):
    run = lowered(run)
    h = zlib.crc32(f"{doc}:{run}".encode())
    return run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run


def counted(rows):
    """Counts of the words of the rows, by the contract."""
    every = Counter(word_of("" if i is None else i, r) for i, t in rows for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    return {w: n for w, n in every.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts, times=10):
    out, form = {}, {}
    for w, n in counts.items():
        others = [(-m, v) for v, m in counts.items() if near(w, v)]
        best = min(others, default=None)
        form[w] = best[1] if best and -best[0] >= times * n else None
        out[w] = (form[w], n, len(others), counts[form[w]] if form[w] else None)
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (out[w][0], root, *out[w][1:])
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def made_words(rng, n, letters):
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(n)]
    out = Counter()
    for w in base:
        for _ in range(rng.randint(1, 6)):
            k = rng.randrange(len(w))
            v = rng.choice([w, w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            out[v] += rng.choice([1, 2, 3, 20, 300])
    return {w: n for w, n in out.items() if w}


@pytest.mark.parametrize("letters", ["ab", "abcdé", "aß😀é漢"])
def test_matches_brute_force(spark, letters):
    counts = made_words(random.Random(len(letters)), 80, letters)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    words = df.select(F.explode(F.array_repeat("word", F.col("n").cast("int"))).alias("word"))
    want = brute({w: n for w, n in counts.items() if n >= 2})
    assert result(spelling_variants(words)) == want
    assert result(spelling_variants(words, filter_bytes=8)) == want  # full filters let all through and lose nothing


def test_each_pair_once(spark):
    counts = made_words(random.Random(5), 60, "abc")
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long").checkpoint()
    got = Counter(tuple(sorted((r.word, r.near))) for r in near_words(vocab).collect())
    assert set(got.values()) <= {1} and set(got) == {(a, b) for a in counts for b in counts if a < b and near(a, b)}


def test_words_of_documents(spark, edge, empty):
    def check(rows, df):
        got = Counter(r.word for r in document_words(df).collect())
        assert {w: n for w, n in got.items() if n >= 2} == counted(rows)

    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["Ärgerlich", "ANTENNEN", "naïveté1naïveté", "x" * 5000, "short", "þórarinn", "foo_barbarbar", "wordword's"]) for _ in range(rng.randint(0, 50)))) for i in range(60)]
    rows += [(None, "repeated repeated"), (3, None), (4, ""), (10**17, "ΑΒΓΔΕΖΗ ещёещёещё résuméResumé")]
    check(rows, spark.createDataFrame(rows, "doc_id long, text string"))
    check([(r.doc_id, r.text) for r in edge.collect()], edge.withColumnRenamed("lang", "word"))
    assert spelling_variants(document_words(empty)).collect() == []


def test_chain_of_forms(spark):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 300, "aaaaabbb": 4000}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").select(F.explode(F.array_repeat("word", F.col("n").cast("int"))).alias("word"))
    got = result(spelling_variants(words.union(spark.createDataFrame([(None,), ("",)], "word string"))))
    assert got == brute(counts) and {r[1] for r in got.values()} == {"aaaaabbb"}


def test_misspelt_letter(spark):
    df = spark.createDataFrame([("abcdefgh", 31 * k) for k in range(8)] + [("abcdefgh", 5)], "w string, k long").select("k", misspelt(F.col("w"), F.col("k")).alias("x"))
    assert {r.k: r.x for r in df.collect()} == {**{31 * k: "abcdefgh"[: 31 * k % 8] + "abcdefgh"[31 * k % 8 + 1 :] for k in range(8)}, 5: "abcdefgh"}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({OP12_SQL})").fetchall()}
    got = result(op12_spelling_variants(spark, SF))
    assert got == want
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert {w: r[2] for w, r in got.items()} == counted(rows)

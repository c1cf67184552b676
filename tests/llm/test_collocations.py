import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from sentryloom.llm import collocations as mod
from sentryloom.llm.collocations import Block, collocations, node_flows, summed_edges
from sentryloom.llm.queries import OP13_SQL, op13_phrase_collocations

SF = "/root/testdata/sf0.01"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, max_words=5, min_count=100, top=2000):
    """The phrases of the rows (lang, text) by dictionaries."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= min_count}
        dropped = {g[i : i + m] for g, a in found.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if a >= found[g[i : i + m]]}
        scored = []
        for g, a in found.items():
            if g not in dropped:
                score, k = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made_rows(seed, n=60):
    rng = random.Random(seed)
    vocab = ["The", "of", "a", "é", "x-y", "don't", "Ünder", "😀", "b\x1fb", "rare"]
    passage = "all of the rights are held by the owner"
    rows = [(None, None), ("en", ""), ("en", " \t\n.,"), (None, "of a of a of a")]
    for _ in range(n):
        words = [rng.choice(vocab[: rng.choice([2, 5, 10])]) + rng.choice(["", "", "", ".", ",", "\t", "\r", "\x0b", "?!"]) for _ in range(rng.randint(0, 60))]
        text = " ".join(words)
        rows.append((rng.choice(["en", "de", None, "und"]), text + (" " + passage if rng.random() < 0.5 else "")))
    return rows + rows[:5]


@pytest.mark.parametrize("max_words,min_count,top", [(5, 3, 2000), (5, 10, 7), (3, 2, 50), (4, 1, 2000)])
def test_matches_brute_force(spark, max_words, min_count, top):
    rows = made_rows(max_words + min_count)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5).withColumn("n", F.lit("extra")).withColumn("phrase", F.lit(1))
    assert result(collocations(df, max_words, min_count, top)) == brute(rows, max_words, min_count, top)


def test_hot_beginnings_small_blocks_and_full_filters(spark, monkeypatch):
    """Two-word beginnings that hold a third of everything are split and give the same counts, as do blocks of a few texts and a filter that lets all through."""
    rng = random.Random(2)
    rows = [("en", " ".join(rng.choice(["one of the", "one of the", "one of", "w%d" % rng.randint(0, 9)]) for _ in range(30))) for _ in range(40)]
    want = brute(rows, 5, 4)
    for name, value in (("HOT_SHARE", 20), ("BUCKET_EDGES", 50), ("BLOCK_BYTES", 300)):
        monkeypatch.setattr(mod, name, value)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    first = mod._first_scan(mod._rows(df, "lang", "text"), 5, 4)
    paths = mod.gram_paths(mod._rows(df, "lang", "text"), first, 5, 4, 8)
    assert mod._unpacked(mod._packed(np.array([0, 70_000, 1 << 31]))).tolist() == [0, 70_000, 1 << 31]
    assert paths.filter("NOT whole").count() > 5 and paths.filter("whole AND hi > lo").count() > 5
    assert result(collocations(df, 5, 4, filter_bytes=8)) == want
    monkeypatch.setattr(mod, "LISTED_WORDS", 0)
    assert result(collocations(df, 5, 4, filter_bytes=8)) == want
    monkeypatch.setattr(mod, "TOP_ROWS", 3)
    assert result(collocations(df, 5, 4, top=2)) == brute(rows, 5, 4, 2)


def test_arithmetic_beyond_64_bits(spark):
    a, n, left, right = 4 * 10**15, 9 * 10**17, 5 * 10**15, 7 * 10**15
    wide = lambda c: F.lit(c).cast("decimal(19,0)")
    got = spark.range(1).select((wide(a) * wide(n) * F.lit(1000).cast("decimal(4,0)")).alias("x"), (wide(left) * wide(right)).alias("y")).selectExpr("x div y AS s").first().s
    assert got == 1000 * a * n // (left * right)


def test_edge_rows(edge, empty):
    rows = [(r.lang, r.text) for r in edge.collect()]
    assert result(collocations(edge, 5, 2)) == brute(rows, 5, 2)
    assert collocations(empty).collect() == []
    with pytest.raises(ValueError):
        collocations(empty, max_words=2)


def test_block_and_flows():
    block = Block(["de", "en"], [b"a b\ta, c d", b"b"])
    assert [block.words[int(i)].as_py() for i in block.at] == [b"a", b"b", b"a", b"c", b"d", b"b"]
    assert block.left.tolist() == [3, 2, 1, 2, 1, 1] and block.lang.tolist() == [0, 0, 0, 0, 0, 1]
    edges, counts = summed_edges(np.array([[0, 1, 2, 3], [0, 1, 2, 0], [0, 1, 2, 3], [1, 1, 2, 3]]), np.array([1, 1, 5, 7]))
    assert edges.tolist() == [[0, 1, 2, 0], [0, 1, 2, 3], [1, 1, 2, 3]] and counts.tolist() == [1, 6, 7]
    assert node_flows(edges, counts).tolist() == [[7, 7, 0], [0, 0, 6], [7, 7, 7]]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({OP13_SQL})").fetchall())
    got = result(op13_phrase_collocations(spark, SF))
    assert got == want and got
    assert got == brute(con.execute("SELECT lang, text FROM documents").fetchall())

import random

from sentryloom.llm.decontamination import contained_items, decontaminate

from .conftest import words
from .test_dedup import shingles


def brute(docs, items):
    out = set()
    sets = {}
    for i, t in docs:
        if i is not None:
            sets.setdefault(i, set()).update(shingles(t))
    for i, s in sets.items():
        for k, t in items:
            q = shingles(t)
            if k is not None and q and 100 * len(s & q) >= 75 * len(q):
                out.add((i, k, len(q), len(s & q)))
    return out


def test_short_items_in_long_documents(spark):
    rng = random.Random(5)
    items = [(k, words(rng, n)) for k, n in enumerate([3, 5, 8, 30, 90, 400, 400])] + [(20, None), (21, " "), (None, words(rng, 9))]
    docs = [(1, None), (2, ""), (None, items[3][1]), (3, words(rng, 20_000))]
    for i in range(60):
        text = words(rng, rng.randint(10, 900)).split()
        item = items[i % 7][1].split()
        cut = item[: max(1, int(len(item) * rng.uniform(0.5, 1)))] if i % 3 else item
        at = rng.randrange(len(text))
        docs.append((10 + i, " ".join(text[:at] + cut + text[at:]).upper() if i % 2 else "\t".join(text[:at] + cut + text[at:])))
    docs += [(100, items[0][1].upper()), (101, items[4][1]), (101, items[4][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item_id", "0 AS n_item")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in contained_items(d, b).collect()}
    assert got == brute(docs, items) and len(got) > 10
    bad = {x[0] for x in got}
    kept = decontaminate(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in docs if i not in bad), key=repr)


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contained_items(empty, some).collect() == []
    assert contained_items(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), none).collect() == []

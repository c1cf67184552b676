import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F
from sentryloom.llm.exact_dedup import exact_dedup
from sentryloom.llm.near_dedup import near_duplicates, one_of_each_group

from .conftest import DOC, edge_rows, words


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """Component by row number; rows with a null id or no shingles stay alone."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    able = [i for i, (k, _) in enumerate(rows) if k is not None and sets[i]]
    for x, i in enumerate(able):
        for j in able[:x]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    groups = {}
    for i in able:
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted(((k, len(sets[i]), min(groups[find(i)]) if i in set(able) else k) for i, (k, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_near_duplicates_edge_cases(edge, empty):
    out = near_duplicates(edge.withColumnRenamed("lang", "kept").withColumnRenamed("source", "component_id"))
    assert got(out) == brute([r[:2] for r in edge_rows()])
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())
    assert near_duplicates(empty).collect() == []


def test_near_duplicates_large_groups_and_chains(spark):
    """A group of near copies around one text, some beyond the threshold, a chain of small steps, and a common passage."""
    rng = random.Random(8)
    rows, base, passage = [], words(rng, 120).split(), words(rng, 60)
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = f"new{rng.random()}"
        rows.append((1000 + i, " ".join(copy)))
    step = words(rng, 100).split()
    for i in range(45):
        step[(i * 2) % 100] = f"s{i}"
        rows.append((500 - i, " ".join(step)))
    rows += [(2000 + i, passage + " " + words(rng, rng.randint(3, 80))) for i in range(60)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOC)
    assert got(near_duplicates(df)) == brute(rows)
    kept = {r.doc_id for r in one_of_each_group(df).collect()}
    assert kept == {i for i, _, c in brute(rows) if i == c}


def test_near_duplicates_of_whole_and_cut_sketches(spark):
    """Linked pairs of a set that its sketch holds whole (at most 64 shingles) and one that is cut, no other text sharing."""
    rng = random.Random(64)
    rows = []
    for n, m in [(64, 85), (64, 84), (63, 83), (62, 82), (64, 80), (60, 80), (56, 74), (52, 69), (49, 65)] * 12:
        text = words(rng, m + 4).split()
        at = len(rows)
        rows += [(at, " ".join(text[: n + 4])), (at + 1, " ".join(text))]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOC)
    assert got(near_duplicates(df)) == brute(rows)


def test_near_duplicates_on_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(near_duplicates(docs)) == brute(rows)


def test_one_of_each_group_keeps_columns_and_repeated_rows_once(edge):
    out = one_of_each_group(edge)
    assert out.columns == edge.columns
    ids = sorted((r.doc_id for r in out.collect()), key=repr)
    assert ids.count(7) == 1 and ids.count(None) == 2 and 8 not in ids and 10 not in ids


def test_exact_dedup_edge_cases(edge, empty):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = edge_rows()
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append(i)
    want = sorted(((i, min((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)])) for i, t, *_ in rows), key=repr)
    out = exact_dedup(edge.withColumnRenamed("lang", "keep_id"))
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in out.collect()), key=repr) == want
    assert exact_dedup(empty).collect() == []
    assert hashlib.sha256(b"").hexdigest()


def test_near_duplicates_recall_over_set_sizes(spark):
    """Every set size from 1 to 200 with a partner as small in similarity as a link may be: one that holds it, and one that each side exceeds."""
    rng = random.Random(200)
    rows, pairs = [], 0
    for n in range(1, 201):
        m = n * 100 // 75  # the largest set that holds n shingles and is linked
        tail = m - n
        text = [f"w{rng.random()}" for _ in range(m + 4)]
        at = 4 * n
        rows += [(at, " ".join(text[: n + 4])), (at + 1, " ".join(text))]
        pairs += tail > 0
        shared = next(s for s in range(1, n + 1) if 100 * s >= 75 * (2 * n - s))  # two sets of n that share as few as they may
        one = [f"v{rng.random()}" for _ in range(shared + 4)]
        rows += [(at + 2, " ".join(one + [f"x{rng.random()}" for _ in range(n - shared)])), (at + 3, " ".join(one + [f"y{rng.random()}" for _ in range(n - shared)]))]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOC)
    out = {r.doc_id: r.component_id for r in near_duplicates(df).collect()}
    missed = [i for i in out if i % 2 and out[i] != i - 1]
    assert not missed and pairs > 190


def test_near_duplicates_of_other_id_types(spark):
    rng = random.Random(5)
    base = words(rng, 40)
    text_ids = near_duplicates(spark.createDataFrame([("b", base), ("a", base + " x"), ("c", "other words here"), (None, base)], "doc_id string, text string"))
    assert {(r.doc_id, r.component_id, r.kept) for r in text_ids.collect()} == {("b", "a", False), ("a", "a", True), ("c", "c", True), (None, None, True)}
    big = (1 << 62) + 1
    large = near_duplicates(spark.createDataFrame([(big, base), (big + 1, base), (None, base)], "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in large.collect()} == {(big, big), (big + 1, big), (None, None)}


def test_exact_dedup_in_a_shuffle_gives_the_same(edge, monkeypatch):
    import sentryloom.llm.exact_dedup as module

    want = sorted((repr(r.doc_id), repr(r.text), r.keep_id, r.group_size, r.kept) for r in exact_dedup(edge).collect())
    monkeypatch.setattr(module, "BROADCAST_GROUPS", 0)
    assert sorted((repr(r.doc_id), repr(r.text), r.keep_id, r.group_size, r.kept) for r in exact_dedup(edge).collect()) == want


def test_of_equal_texts_with_null_ids_one_stays(spark):
    rows = [(None, "same text"), (None, "same  text"), (None, "same\ttext"), (None, None), (None, ""), (None, "alone"), (4, "four"), (None, "four"), (None, "four")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit(7))
    out = exact_dedup(df).collect()
    kept = Counter(" ".join((r.text or "").split()) for r in out if r.kept)
    assert len(out) == len(rows) and kept == {"same text": 1, "": 1, "alone": 1, "four": 1}
    assert {(r.text, r.group_size) for r in out if r.keep_id == 4} == {("four", 3)} and [r.doc_id for r in out if r.kept and r.text == "four"] == [4] and all(r._row == 7 for r in out)

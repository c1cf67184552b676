import corpus_pipeline as P

from .test_decontamination import brute as contained
from .test_dedup import brute as components
from .test_mixing_sharding import targets

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(P.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]

    named = stages["language"](spark, docs, SF)
    assert named.columns == docs.columns
    assert {r.doc_id for r in named.collect()} == {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}

    one = stages["near_duplicates"](spark, named, SF)
    stay = {i for i, _, c in components([(r.doc_id, r.text) for r in named.collect()]) if i == c}
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(stay)

    clean = stages["decontamination"](spark, one, SF)
    bad = {x[0] for x in contained([(i, rows[i].text) for i in stay], items)}
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(stay - bad)

    mixed = stages["mixing"](spark, clean, SF)
    sizes, got, longest = {}, {}, {}
    for i in stay - bad:
        n, s = len(rows[i].text.split()), rows[i].source
        sizes[s], longest[s] = sizes.get(s, 0) + n, max(longest.get(s, 0), n)
    for r in mixed.collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert mixed.columns == docs.columns and all(abs(got.get(s, 0) - t) <= longest[s] for s, t in targets(sizes).items())

    placed = stages["sharding"](spark, mixed, SF).collect()
    counts = [sum(r.shard == s for r in placed) for s in range(P.SHARDS)]
    assert sum(counts) == mixed.count() and max(counts) - min(counts) <= 1


def test_run_gives_the_stages_in_a_row(spark):
    out = P.run(spark, SF)
    assert {"doc_id", "text", "shard", "slot"} <= set(out.columns) and out.count() > 0

"""Gates let every text through that has a match of their kind, and a text is made plain once."""

import random
import re

from sentryloom.operators import content as C

LEAST = {
    "ipv4": ["1.2.3.4", "é999.1.22.333."],
    "domain": ["a.bc", "x-1.y.zz", "ßa.bcß"],
    "url": ["https://x", "http://é"],
    "md5": ["A" * 32],
    "sha1": ["0f" * 20],
    "sha256": ["b1" * 32],
    "cve": ["cVe-2024-12345", "CVE-1999-0001é"],
    "email": ["a@b.cd", "a%@-.xx", ".a+b@c.d.ee"],
}


def test_gated_kinds_find_what_the_patterns_find(spark):
    rng = random.Random(1)
    parts = [x for xs in LEAST.values() for x in xs] + ["1.2.3", "A" * 31, "g" * 40, "CVE-12-1", "@", "a.b", "htt p", "Ende. Neu", "é", ".", "-", "4"]
    texts = [None, "", *parts, *("".join(rng.choice([" ", "", ", ", "é"]) + rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(300))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = C.extract_entities(df, "text")
    want = []
    for i, t in enumerate(texts):
        for k, (p, c) in C.ENTITIES.items():
            plain = re.sub(r"[^\x00-\x7F]", "¤", t or "") if r"\b" in p else t or ""
            low = str.lower if k in ("md5", "sha1", "sha256") else str.upper if k == "cve" else str
            want += [(i, k, low(m), c) for m in re.findall(p, plain, re.ASCII)]
    assert sorted((r.id, r.kind, r.value, r.confidence) for r in found.collect()) == sorted(want)
    assert {k for _, k, _, _ in want} == set(C.ENTITIES)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("¤") == 1


def test_a_gate_is_part_of_every_match():
    for kind, texts in LEAST.items():
        gate = C.ENTITY_GATES[kind]
        assert all(re.search(C.ENTITIES[kind][0], t, re.ASCII) and re.search(gate, t) for t in texts)

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from sentryloom.llm.min_slack import fullest, min_slack_plan, pack_min_slack, sequences
from sentryloom.llm.queries import op11_min_bin_slack
from tokenizers import Tokenizer

from .conftest import edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"


def sums(lengths, room):
    reach = {0}
    for length, count in lengths:
        reach = {s + k * length for s in reach for k in range(count + 1) if s + k * length <= room}
    return reach


def test_fullest_combination_matches_all_sums():
    rng = random.Random(8)
    for _ in range(200):
        room = rng.randint(0, 50)
        lengths = sorted(((x, rng.randint(1, 4)) for x in rng.sample(range(1, 41), rng.randint(0, 8)) if x <= room), reverse=True)
        got = fullest(lengths, room)
        assert all(0 < c <= dict(lengths)[x] for x, c in got)
        assert sum(x * c for x, c in got) == max(sums(lengths, room))


def test_plan_is_the_search_bin_by_bin():
    rng = random.Random(9)
    for _ in range(40):
        width = rng.randint(5, 60)
        counts = Counter(rng.randint(1, width) for _ in range(rng.randint(0, 200)))
        plan = min_slack_plan(counts, width)
        held = Counter()
        for pattern, bins in plan:
            assert sum(x * c for x, c in pattern) <= width and bins > 0
            for x, c in pattern:
                held[x] += c * bins
        assert held == counts
        left, bins = Counter(counts), 0
        while left:  # one bin at a time
            seed = max(left)
            left[seed] -= 1
            rest = fullest([(x, left[x]) for x in sorted(left, reverse=True) if left[x] > 0 and x <= width - seed], width - seed)
            for x, c in rest:
                left[x] -= c
            left, bins = +left, bins + 1
        assert bins == sum(b for _, b in plan)


def packed_by_row(df):
    parts = {}
    for r in df.collect():
        parts.setdefault(r.sequence_id, []).append(r)
    return parts


def test_every_token_has_one_place(edge, docs, empty):
    for df in (edge, docs):
        width, texts, seen = 256, Counter(), Counter()
        out = pack_min_slack(df.withColumnRenamed("lang", "length"), PATH, width)
        bins = packed_by_row(out)
        whole = {}
        for rows in bins.values():
            rows.sort(key=lambda r: r.offset)
            assert [r.offset for r in rows] == [0, *np.cumsum([r.length for r in rows])[:-1].tolist()] and sum(r.length for r in rows) <= width
            for r in rows:
                assert len(r.ids) == 4 * r.length
                whole.setdefault(r.doc_id, []).append((r.piece, r.start, r.ids))
        for r in df.collect():
            ids = np.array([*LIB.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
            first = len(ids) % width or width
            cuts = [0, *range(first, len(ids), width), len(ids)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                texts[r.doc_id, k, a, ids[a:b].tobytes()] += 1
        for doc, parts in whole.items():
            seen.update((doc, *p) for p in parts)
        assert seen == texts
        joined = {r.sequence_id: (r.n_tokens, r.ids) for r in sequences(out.select("*")).collect()}
        assert {len(x) // 4 for _, x in joined.values()} <= set(range(1, width + 1)) and sum(n for n, _ in joined.values()) == sum(len(k[3]) // 4 * n for k, n in texts.items())
    assert pack_min_slack(empty, PATH).collect() == []


def test_query_digests(spark, docs):
    rows = op11_min_bin_slack(spark, SF).collect()
    tokens = {r.doc_id: np.array([*LIB.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in docs.collect()}
    assert all(zlib.crc32(tokens[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
    assert sum(r.length for r in rows) == sum(map(len, tokens.values()))
    least = -(-sum(map(len, tokens.values())) // 1024)
    assert len({r.sequence_id for r in rows}) <= 1.02 * least + 1


def test_edge_rows_keep_null_ids(edge):
    ids = [r.doc_id for r in pack_min_slack(edge, PATH).filter("piece = 0").collect()]
    assert Counter(ids) == Counter(r[0] for r in edge_rows())

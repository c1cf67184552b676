import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from sentryloom.llm._transducer import Transducer, compile_tokenizer
from sentryloom.llm.packing import best_fit_decreasing, pack_tokens
from sentryloom.llm.token_counts import count_tokens
from tokenizers import Tokenizer

from .conftest import edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
MACHINE = Transducer(PATH, compile_tokenizer(PATH))


def library(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ09'strevldm \n\t\r\xa0 é漢😀!-_\x00\x1c\x85²"), max_size=200), max_size=4))
def test_transducer_gives_the_librarys_tokens(texts):
    texts = [*texts, "don't we'll I've <|endoftext|>x<|endoftext|>"]
    assert [x.tolist() for x in MACHINE.token_ids(texts)] == [library(t) for t in texts]


def test_counts_edge_cases(edge, empty):
    out = {(r.doc_id, r.text): r for r in count_tokens(edge.withColumnRenamed("lang", "n_tokens"), PATH).collect()}
    for i, t, *_ in edge_rows():
        r = out[i, t]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((t or "").encode()), len(library(t)), len(library(t)) > 512)
    assert count_tokens(empty, PATH).collect() == []


def test_packing_is_a_round_trip(edge, docs, empty):
    for df in (edge, docs):
        parts, width = {}, 256
        for r in pack_tokens(df, PATH, width=width, group_tokens=20_000).collect():
            ids, at = np.frombuffer(r.token_ids, "<i4"), np.frombuffer(r.position_ids, "<i4")
            assert len(ids) == len(at) == width and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= width
            for doc, k, a, b in zip(r.doc_ids, r.segment_numbers, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
                assert at[a:b].tolist() == list(range(b - a))
                parts.setdefault(doc, []).append((k, ids[a:b].tolist()))
        rows = {}
        for r in df.collect():
            if library(r.text):
                rows.setdefault(r.doc_id, []).append(library(r.text))
        assert set(rows) == set(parts)
        for doc, texts in rows.items():
            assert sorted(x for t in texts for x in t) == sorted(x for _, p in parts[doc] for x in p)
            if len(texts) == 1:
                assert [x for _, p in sorted(parts[doc]) for x in p] == texts[0]
    assert pack_tokens(empty, PATH).collect() == []


def test_best_fit_decreasing_matches_a_plain_search():
    rng = random.Random(4)
    for _ in range(30):
        width = rng.randint(5, 60)
        sizes = np.array([rng.randint(1, width) for _ in range(rng.randint(0, 80))], int)
        rows, free = [], []
        for i in np.argsort(-sizes, kind="stable"):
            fit = [(free[r], r) for r in range(len(rows)) if free[r] >= sizes[i]]
            if fit:
                r = min(fit)[1]
            else:
                r = len(rows)
                rows.append([])
                free.append(width)
            rows[r].append(int(i))
            free[r] -= int(sizes[i])
        mine = best_fit_decreasing(sizes, width)
        assert len(mine) == len(rows) and sorted(i for r in mine for i in r) == list(range(len(sizes)))
        assert all(sizes[r].sum() <= width for r in mine)

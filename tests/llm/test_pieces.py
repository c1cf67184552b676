"""Batches and vocabularies go through Python in pieces of bounded size."""

import numpy as np
import pyarrow as pa

from sentryloom.llm._spark import pieces
from sentryloom.llm._words import DESCRIBED_WORDS, WordTable


def test_batches_are_cut_by_bytes_and_lose_nothing():
    texts = ["a" * 5, None, "", "ü" * 4, "b" * 30, None, "c", "d" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["id", "text"])
    for cut in (batch, batch.slice(2, 5), batch.slice(0, 0)):
        got = list(pieces(cut, 1, 10))
        assert [v for p in got for v in p.column(0).to_pylist()] == cut.column(0).to_pylist()
        assert [v for p in got for v in p.column(1).to_pylist()] == cut.column(1).to_pylist()
        assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 10 for p in got)
    assert len(list(pieces(batch, 1, 10))) > 3 and len(list(pieces(batch, 1))) == 1


def test_words_are_described_a_bounded_number_at_a_time():
    asked = []

    def describe(words):
        asked.append(len(words))
        return np.array([[int(w)] for w in words], np.int64).reshape(-1, 1)

    n = 2 * DESCRIBED_WORDS + 100
    text = " ".join(map(str, range(n)))
    table = WordTable(describe, held=n)
    for _ in range(2):
        assert [rows[:, 0].tolist() for *_, rows, _ in table.described([text])] == [list(range(n))]
    assert max(asked) <= DESCRIBED_WORDS and sum(asked) == n

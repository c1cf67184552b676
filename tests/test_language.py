"""Both ways of language detection on odd rows."""

from __future__ import annotations

import pytest
from sentryloom.operators import content as C


@pytest.mark.parametrize("slice_chars", [1 << 20, 7])
def test_both_ways_agree(spark, monkeypatch, slice_chars):
    texts = [("the cat and the hat", "en"), ("der hund und die katze", "de"), ("ÉTÉ à la plage 😀😀😀", "fr"), (None, "en"), ("", "de"), ("ab", "en"), ("the dog and", None), ("zzzzzz", None), ("die und der", None), ("İstanbul the the " * 40, "tr")]
    df = spark.createDataFrame([((1 << 60) + i if i != 3 else None, t, lang) for i, (t, lang) in enumerate(texts)], "id long, text string, lang string").coalesce(1)
    monkeypatch.setattr(C, "SLICE_CHARS", slice_chars)
    model = C.fit_language(df, "text", "lang").checkpoint()
    counted = {}
    for t, lang in texts:
        low = spark.createDataFrame([(t,)], "t string").selectExpr("lower(t)").first()[0] if t else ""
        for i in range(len(low) - 2):
            if lang and len(t) >= 3:
                counted[lang, low[i : i + 3]] = counted.get((lang, low[i : i + 3]), 0) + 1
    assert {(r.lang, r.gram) for r in model.collect()} == set(counted)
    here = {r.id: r.detected for r in C.detect_language(df, model, "id", "text", "lang").collect()}
    monkeypatch.setattr(C, "SMALL", 0)
    far = {r.id: r.detected for r in C.detect_language(df, model, "id", "text", "lang").collect()}
    assert here == far and here[None] == "unknown" and here[(1 << 60) + 7] == "unknown" and here[(1 << 60) + 8] == "de"
    assert C.detect_language(df, model.limit(0), "id", "text", "lang").filter("detected <> 'unknown'").count() == 0

"""User hooks: message and batch processors, model calls with a cache, fallbacks, a table function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def _with(batch: pa.RecordBatch, columns: Sequence[Sequence], fields: Sequence[T.StructField]) -> pa.RecordBatch:
    """The batch as it is, with new columns."""
    new = [pa.array(x, to_arrow_type(f.dataType), from_pandas=True) for x, f in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *[f.name for f in fields]])


def _frame(batch: pa.RecordBatch) -> pd.DataFrame:
    """The batch for pandas, with its nullable integer types: whole numbers beside a null stay whole numbers."""
    return batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype(), pa.int16(): pd.Int16Dtype(), pa.int8(): pd.Int8Dtype()}.get)


def map_messages(df: DataFrame, fn: Callable[[dict], object], result: str = "string") -> DataFrame:
    """``fn`` on each message (a dict of Python values), with ``result``, ``ok``, ``error`` and ``seconds``; an exception fails its row only.

    The message's own columns pass unchanged.
    """
    fields = T.StructType.fromDDL(f"result {result}, ok boolean, error string, seconds double").fields

    kind = to_arrow_type(fields[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                began = time.perf_counter()
                try:
                    said = pa.scalar(fn(row), kind, from_pandas=True).as_py()  # a value of another type fails its row as well
                    out.append((said, True, None, time.perf_counter() - began))
                except Exception as e:  # noqa: BLE001  the row carries it
                    out.append((None, False, f"{type(e).__name__}: {e}", time.perf_counter() - began))
            yield _with(batch, [[x[i] for x in out] for i in range(4)], fields)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], name: str, kind: str) -> DataFrame:
    """``fn`` on each batch of rows, giving one value a row; the rows' own columns pass unchanged."""
    fields = T.StructType.fromDDL(f"{name} {kind}").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _with(batch, [fn(_frame(batch))], fields)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def enrich_with(df: DataFrame, text: str, model: Callable[[pd.Series], pd.Series], when: Column, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with ``answer`` where ``when`` holds, and the cache (``request, answer``, request the MD5 of the input) after it.

    Distinct inputs are asked once, and only those that the cache has not.
    """
    asked = df.filter(when & F.col(text).isNotNull()).select(F.md5(text).alias("request"), F.col(text).alias("_t")).dropDuplicates(["request"])
    if cache is not None:
        asked = asked.join(cache.select("request"), "request", "left_anti")
    call = F.pandas_udf(model, "string")
    fresh = asked.select("request", call("_t").alias("answer"))
    known = fresh if cache is None else cache.select("request", "answer").unionByName(fresh)
    out = df.withColumn("request", F.when(when, F.md5(text))).join(known, "request", "left").drop("request")
    return out, known


def fallback_chain(df: DataFrame, *steps: tuple[str, Column]) -> DataFrame:
    """The first provider's answer that is not null, and which one gave it."""
    answer = F.coalesce(*[c for _, c in steps])
    source = reduce(lambda a, s: a.when(s[1].isNotNull(), s[0]), steps[1:], F.when(steps[0][1].isNotNull(), steps[0][0]))
    return df.withColumns({"answer": answer, "answered_by": source})


def fallback_calls(df: DataFrame, *steps: tuple[str, Callable[[pd.DataFrame], pd.Series]]) -> DataFrame:
    """The same for providers in Python (answers as text): each is asked only for the rows that have no answer yet.

    A provider that raises has no answer for that batch, and the next one is asked.
    """
    fields = T.StructType.fromDDL("answer string, answered_by string").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = _frame(batch)
            answer, source = (pd.Series([None] * len(frame), frame.index, object) for _ in range(2))
            for name, ask in steps:
                rows = frame[answer.isna()]
                if not len(rows):
                    break
                try:
                    got = ask(rows).dropna()
                except Exception:  # noqa: BLE001, S112  the next provider is asked
                    continue
                answer[got.index], source[got.index] = got.astype(object), name
            yield _with(batch, [answer, source], fields)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def register_entities(spark: SparkSession, name: str = "explode_entities") -> None:
    """A table function for SQL: ``SELECT ... FROM t, LATERAL explode_entities(t.text)`` gives kind, value, start and stop."""
    import re

    from ..operators.content import ENTITIES

    patterns: Sequence[tuple[str, object]] = [(k, re.compile(p)) for k, (p, _) in ENTITIES.items()]

    class Entities:
        def eval(self, text: str):
            for kind, pattern in patterns:
                for m in pattern.finditer(text or ""):
                    yield kind, m.group(), m.start(), m.end()

    spark.udtf.register(name, F.udtf(Entities, returnType="kind string, value string, start int, stop int"))


def propagate_correlation(headers: Column, payload_id: Column, seed: Column) -> Column:
    """The header's correlation id, then the payload's, then one made from the message itself."""
    return F.coalesce(F.nullif(F.element_at(headers, "correlation_id"), F.lit("")), F.nullif(payload_id, F.lit("")), F.md5(seed))

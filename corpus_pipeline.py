"""A corpus pipeline of the operators in ``sentryloom.llm``, one stage after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from sentryloom.llm._spark import table, written
from sentryloom.llm.decontamination import decontaminate
from sentryloom.llm.language_id import fold, identify_language
from sentryloom.llm.mixing import mixed_documents
from sentryloom.llm.near_dedup import one_of_each_group
from sentryloom.llm.sharding import shard_rows

SHARDS = 24
#: Mean marginal below which no language is certain enough for a document to stay.
LEAST_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; those without letters or without a likely language go.

    The model learns from the ``lang`` of two thirds of the documents (crc32 of the id modulo
    3 is not 1) and predicts from texts alone.
    """
    named = identify_language(docs, docs.filter(fold("doc_id", 3) != 1))
    return named.filter((named["lang_pred"] != "und") & (named["score"] >= LEAST_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ``shard`` and ``slot``."""
    return shard_rows(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The language model and the hash-random orders have no SQL form; a test holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

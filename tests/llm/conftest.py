import random

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgéñ") for _ in range(rng.randint(2, 6))) for _ in range(n))


def edge_rows():
    """Null and empty texts, a null id, repeated rows, ties, white space only, a long text."""
    rng = random.Random(3)
    long = words(rng, 30_000)
    base = words(rng, 40)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "one  TWO "), (6, "one two"), (7, base), (7, base), (8, base + " x"), (None, base), (None, None), (9, long), (10, long + " tail"), (11, "???"), (12, base.upper())]
    return [(i, t, "en", None if k % 3 == 0 else f"s{k % 2}", len(t or "")) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOC)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

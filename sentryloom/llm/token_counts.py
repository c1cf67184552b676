"""Token counts of whole texts by compiled transducers."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._spark import append_columns, renamed_apart
from ._transducer import compile_tokenizer, transducer


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``n_bytes, n_tokens, over_limit``.

    ``tokenizer`` is the path of a byte-level BPE file, readable on every node.  Counts are
    those of its library without added tokens; its special string inside a text is one
    token.  Null text counts as empty: no bytes, no tokens.  A text of any length is read
    whole.  Repeated rows count alike, an empty table gives an empty result, ids and other
    columns pass unchanged, and input columns named like the outputs are replaced.  One
    pass, no shuffle.
    """
    docs = renamed_apart(docs, ["n_bytes", "n_tokens", "over_limit"])
    classes = compile_tokenizer(tokenizer)

    def start() -> Callable[[list], list[pa.Array]]:
        machine = transducer(tokenizer, classes)
        return lambda texts: [pa.array(machine.token_counts(texts), pa.int64())]

    out = append_columns(docs, text_col, [T.StructField("n_tokens", T.LongType())], start)
    return out.withColumn("n_bytes", F.octet_length(F.coalesce(text_col, F.lit(""))).cast("long")).withColumn("over_limit", F.col("n_tokens") > limit).select(*docs.columns, "n_bytes", "n_tokens", "over_limit")

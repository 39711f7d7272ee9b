from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents rows from (doc_id, text[, lang, source]) tuples."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS) if full else spark.createDataFrame([], DOCS)
        return df.repartition(parts) if full else df
    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empties, white space, very long, repeats, other scripts."""
    return [None, "", " ", "\n\t ", "a", "The same row.", "The same row.", "x " * 5000, "y" * 30000,
            "don't  we'll 's 12 3a", "a <|endoftext|> b<|endoftext|>", "中文 字 , ñandú é́ ½²",
            "tab\tand\x0bothers\x0c\r\n\x1c end ", "word " * 13, "ÀÉ ß × ÷ 123 !?"]

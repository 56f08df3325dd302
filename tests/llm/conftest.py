from __future__ import annotations

import pytest
from pyspark.sql import types as T

# Extra columns whose names the operators use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("text_hash", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("rep", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, len(text or ""), "a", "b", "c", "d", "e"))
        return spark.createDataFrame(full, SCHEMA)

    return make


ODD = [
    (None, None),
    (None, ""),
    (1, ""),
    (2, None),
    (3, "one"),
    (3, "one"),
    (4, "a b c d e f g " * 3000),
    (5, " \n\t\n"),
    (6, "ünï cödé 漢字 😀\nline\n" * 4),
]


@pytest.fixture
def odd():
    """NULLs, empty and long texts, repeated rows, blank lines, other scripts."""
    return ODD

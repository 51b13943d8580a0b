from __future__ import annotations

import pytest
from pyspark.sql import types as T

from ridepulse.llm.common import ready

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # extra columns whose names clash with those the operators make
        *(T.StructField(c, T.StringType()) for c in ("ids", "start", "size", "fp", "u", "part", "trie", "b", "target")),
    ]
)


@pytest.fixture()
def make_docs(spark):
    """documents rows from (doc_id, text[, lang[, source]]) tuples, with clashing extra columns."""
    ready(spark)

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, None, None)[:4] if len(r) < 4 else r[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), *["x"] * 9))
        return spark.createDataFrame(full, DOCS)

    return make

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Frame of documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        return spark.createDataFrame([(*r, *(None,) * (4 - len(r)), None) for r in rows], DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def clashing(spark):
    """Adds columns named like those the operators use inside."""

    def add(df):
        from pyspark.sql import functions as F

        names = ("id", "body", "row", "fp", "digest", "score", "kept", "pieces", "decoded", "lines", "word", "root")
        return df.select("*", *[F.lit("x").alias(n) for n in names])

    return add

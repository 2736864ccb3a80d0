from __future__ import annotations

import pytest

DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_docs(spark):
    """(texts or (doc_id, text[, lang, source])) -> a documents frame."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, lang, source = (*row, *["en", "src0"][len(row) - 2 :])[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS_SCHEMA)

    return build


@pytest.fixture(scope="session")
def real_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

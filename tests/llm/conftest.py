from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with an extra column whose name could clash with an operator's own."""

    def build(rows):
        full = [(i, t, "en", s, len(t) if t is not None else None, "x") for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, size string")

    return build

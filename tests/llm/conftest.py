from __future__ import annotations

import pytest

# the session fixture comes from the folder above


@pytest.fixture
def docs_of(spark):
    """Documents from texts: ids count from 0 unless pairs are given; extra columns clash with working names."""

    def make(texts, start=0):
        rows = [(t if isinstance(t, tuple) else (start + k, t)) for k, t in enumerate(texts)]
        rows = [(i, t, "en", "src", len(t or ""), 7, "x") for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, h long, key string"
        )

    return make

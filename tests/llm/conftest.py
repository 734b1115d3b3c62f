from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text, lang, source) -> the table documents, with a further column of a clashing name."""

    def make(rows):
        return spark.createDataFrame([(*r, 1)[:5] if len(r) == 4 else (r[0], r[1], None, None, 1) for r in rows], "doc_id long, text string, lang string, source string, score int")

    return make

from __future__ import annotations

import pytest


@pytest.fixture()
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, with a clashing extra column."""

    def build(rows, extra=()):
        rows = [(i, t, "en", "src0", None if t is None else len(t), *([0] * len(extra))) for i, t in rows]
        types = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(rows, ", ".join([types, *(f"{c} long" for c in extra)]))

    return build

from __future__ import annotations

import pytest

EDGE_TEXTS = [None, "", " ", "\n\n", "a", "12 !! 34", "word " * 30_000, "x" * 200_000, "tie tie tie", "tie tie tie", "é漢😀 ä ß"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids, null and extreme texts, repeated rows and columns whose names clash with inner ones."""
    rows = [(i if i != 3 else None, t, None if i % 2 else "en", i, i) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[-2], (0, "other text with the same id as another row", "en", 7, 7)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, __id long, kept int"
    ).selectExpr("*", "'s' as source", "cast(length(text) as bigint) as n_chars", "1 as fp", "2 as root", "3 as key", "4 as line")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("false")

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept_text string, n_words string"


@pytest.fixture
def documents(spark):
    """Documents from ``(number, text)``; two more columns have names that results use too."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "s", len(t) if t else 0, "other", "x") for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


EDGES = [(None, "a line without a number, quite long"), (1, None), (2, ""), (3, " \n\t\n "), (3, " \n\t\n "), (4, "ein Wort"), (5, "日本語のテキスト　です。\n" * 3)]


@pytest.fixture
def edges():
    """Null, empty, blank, repeated and short rows."""
    return EDGES

"""Awkward inputs that every operator has to take: nulls, empty and long texts, repeats, clashing column names."""

from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as extra columns of the input.
CLASH = ["row", "key", "text_key", "h", "fp", "group", "site", "pos", "place", "gone", "clean", "id", "draw", "pattern", "score", "part", "last", "h.x"]


def docs_frame(spark, rows):
    """Rows (doc_id, text, lang, source) as a documents table with extra columns that clash."""
    full = [(*r, len(r[1]) if r[1] is not None else None, *[f"x{i}" for i in range(len(CLASH))]) for r in rows]
    return spark.createDataFrame(full, COLUMNS + "".join(f", `{c}` string" for c in CLASH))


LONG = "the quick brown fox jumps over the lazy dog and runs away. " * 3000


def odd_rows():
    return [
        (1, "The quick brown fox jumps over the lazy dog today.\nAll rights reserved here.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog today.\nAll rights reserved here.", "en", "a"),  # repeated row
        (1, "Another text under the same id, with words of its own.", "en", None),
        (2, "The quick brown fox jumps over the lazy dog today.\nAll rights reserved here.", None, "b"),  # copy
        (3, None, "en", "c"),
        (4, "", "de", "c"),
        (5, " \n\t ", None, None),
        (None, "A text without an id, but with words.", "en", "d"),
        (None, None, None, None),
        (6, LONG, "en", "e"),
        (7, "x" * 5000, "fr", "e"),
        (8, "One.", "fr", "f"),
    ]


@pytest.fixture
def odd_docs(spark):
    return docs_frame(spark, odd_rows())


@pytest.fixture
def no_docs(spark):
    return docs_frame(spark, [])


@pytest.fixture
def make_docs(spark):
    return lambda rows: docs_frame(spark, rows)

"""Small document tables with everything that may be odd about them."""

from __future__ import annotations

import pytest

from logsync.llm.queries import importable

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers_import(spark):
    importable(spark)


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) pairs."""

    def make(*rows):
        full = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


LONG = " ".join(f"word{i % 997}x{i % 13} and so on." for i in range(6000))


@pytest.fixture
def odd_docs(make_docs):
    """Nulls, empty and very long texts, blanks, ties and repeated rows."""
    return make_docs(
        (1, None),
        (2, ""),
        (3, "   \n\t "),
        (4, LONG),
        (5, "One sentence here."),
        (5, "One sentence here."),
        (6, "One sentence here."),
        (7, "7 8 9 !!! \U0001f600"),
        (None, "A text without an id, which nobody can link to."),
        (None, None),
        (9, "É à ü ß ñ \x00 tail\x1c end  twice"),
    )

from __future__ import annotations

import pytest

from costpulse import session
from costpulse.llm.common import small_batches

# Every shape the operators must define a result for: nulls, empty and very long texts, ties,
# repeated rows, and extra columns whose names the operators use themselves.
LONG = " ".join(f"w{i % 977} is{i % 13}" for i in range(30000))
ODD_ROWS = [
    (1, None, "en", "a", 0, "x"), (2, "", None, "a", 0, "x"), (3, LONG, "en", None, 1, "x"),
    (4, "Same words here in this line, all of them.\nand a second line of text", "en", "b", 2, None),
    (5, "Same words here in this line, all of them.\nand a second line of text", "de", "b", 2, None),
    (5, "Same words here in this line, all of them.\nand a second line of text", "de", "b", 2, None),
    (None, "a text without an id\nand a second line of text", "fr", "c", 3, "y"),
    (None, None, None, None, None, None), (7, "\n\n \n", "fr", "c", 3, "y"),
    (8, "Wörter über Größe 日本語 \U0001f600 mit a@b.co und 10.0.0.1", "de", "c", 3, "y"),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="session")
def llm(spark):
    session.prepare(spark)
    small_batches(spark)
    return spark


@pytest.fixture()
def odd(llm):
    return llm.createDataFrame(ODD_ROWS, ODD_SCHEMA)


@pytest.fixture()
def empty(llm):
    return llm.createDataFrame([], ODD_SCHEMA)

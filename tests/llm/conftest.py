from __future__ import annotations

import pytest

LONG = "alpha beta gamma delta " * 30_000
DOCS = [
    (1, "One shared line of text\nown words of the first\n\n short ", "en", "a", 1),
    (2, "One shared line of text\nother words of the second", None, None, None),
    (3, "  ONE SHARED LINE OF TEXT\t\nthird", "en", "a", 1),
    (4, None, "en", "a", 0),
    (5, "", "en", "a", 0),
    (6, " \t\n \x0b ", "en", "a", 0),
    (7, LONG, "en", "a", 1),
    (7, LONG, "en", "a", 1),
    (8, LONG + "epsilon", "en", "a", 1),
    (9, "wörter ▁ und Zeichen 日本 <|endoftext|> x<|endoftext|>\r\nzwei", "de", "b", 1),
    (10, "word", "en", "a", 1),
    (11, "WORD", "en", "a", 1),
    (None, "One shared line of text\nno id", "en", "a", 1),
    (None, None, None, None, None),
]


@pytest.fixture(scope="session")
def edge_rows():
    return DOCS


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with names that operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, node int, row string, keep string, text_hash int"
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in DOCS], schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def rows_of():
    return sorted_rows

from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, blocks long"
LONG_LINE = "the same long boiler plate line of text"


def _edge_rows():
    body = " ".join(f"word{i % 50}x{i}" for i in range(60))
    rows = [
        (1, body, "en", "a", None), (2, body, "en", "a", 7), (3, None, None, None, None), (4, "", "en", "b", 0),
        (5, "   \n\t\n", None, "b", 5), (6, LONG_LINE + "\nown line of six", "en", "b", None),
        (7, "  " + LONG_LINE.upper() + "\t\nown line of seven", "en", None, None),
        (8, LONG_LINE + "\n" + LONG_LINE + "\nx", "en", "a", None), (9, LONG_LINE, "de", "a", None),
        (None, body + " tail", "en", "a", None), (10, "一二三 日本語 テキスト", "ja", "c", None),
        (11, "12345 67890 !!", "en", "c", None), (12, "ü" * 30_000, "de", "c", None),
        (13, ("lorem ipsum dolor sit amet " * 8_000), "la", "a", None), (14, "<|endoftext|>  odd \n space", "en", "a", None),
        (15, body.replace("word10x10", "changed"), "en", "b", None),
        # rows that repeat an id: equal, and with another text
        (6, LONG_LINE + "\nown line of six", "en", "b", None), (4, "another text under id four", "en", "b", None),
    ]
    return [(*r, 0.5, "x", 3) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and extra columns whose names clash with those of results."""
    return spark.createDataFrame(_edge_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    from specimen.llm.common import documents
    return documents(spark, "/root/testdata/sf0.001").repartition(3).cache()

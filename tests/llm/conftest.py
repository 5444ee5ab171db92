"""Small document tables for the training-data operators."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, to clash with.
EXTRA = "row long, name string, f0 long, tie string, score double, rate int, block int, copies string, h1 int, ids string, train int, toxic_x int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, and extra columns."""
    long_text = " ".join(f"word{k % 977} Abc" for k in range(30_000))
    lines = "One line of text here.\nAnother line follows it.\nAnd a third one ends."
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, long_text), (5, long_text.upper()), (5, long_text.upper()),
        (6, lines), (7, lines + "\nIts own end."), (None, lines), (None, None), (8, "a"), (9, "Ünïcödé — 中文 ½ 🙂"),
        (10, "x" * 70_000), (11, "cc by all rights reserved"), (12, lines), (12, "Another text of the same id."),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "s", None if t is None else len(t)) + (k, "n", 1, "t", 0.5, 2, 3, "c", 4, "i", 1, 0) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, f"{SCHEMA}, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")

from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, print string"
FILLER = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing columns."""
    texts = [
        (1, FILLER, "en", "a"),
        (1, FILLER, "en", "a"),
        (1, "other words under the same id", "en", "a"),
        (2, None, None, None),
        (None, FILLER, "en", "b"),
        (None, None, None, None),
        (3, "", "en", "b"),
        (4, " \n\t ", None, "b"),
        (5, "word " * 60_000, "en", "c"),
        (6, "x" * 200_000, "de", "c"),
        (7, FILLER.upper() + "!", "en", "c"),
        (8, "123 456 \x00 é́ \U0001f600", "de", ""),
    ]
    rows = [(i, t, lang, s, None if t is None else len(t), 7, "clash", "clash") for i, t, lang, s in texts]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")

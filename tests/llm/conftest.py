from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

BASE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls everywhere, ties, repeated rows, empty and very long texts."""
    rows = [
        (1, BASE, "en", "a"), (2, BASE, "en", "b"), (3, BASE.upper(), None, None),
        (4, BASE + " tail", "en", "a"), (5, BASE.replace("word30", "other"), "de", "b"),
        (6, None, "en", "a"), (7, "", "en", "a"), (8, " \t\n ", "fr", "c"), (9, "one two", "en", "c"),
        (10, "One  Two", "en", "c"), (11, "a b c d", "en", None), (12, "a b c d e", "en", "z"),
        (13, LONG, "en", "a"), (14, LONG + " end", "en", "b"), (15, "line\nline\nline\n\nline", "en", "b"),
        (16, "né à l'été ### $$$ 5% |x| " * 20, "fr", "c"), (None, "no id " * 30, "en", "a"),
        (None, None, None, None), (17, BASE, "en", "a"), (17, BASE, "en", "a"),
        (18, "  x y 　 z", "ja", "c"),
    ]
    return [(a, b, c, d, None if b is None else len(b)) for a, b, c, d in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor 127.0.0.1 sit amet, " * 6000


@pytest.fixture(scope="session")
def documents(load):
    return load("documents")


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty, odd and very long texts, repeated rows, clashing extra columns."""
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, "a", 4),
        (4, "one", "en", None, 3),
        (5, "1 2 3 @ . , -", "en", "b", 13),
        (6, "The same words stand here twice, mail x.y@z.org.", "en", "b", 48),
        (6, "The same words stand here twice, mail x.y@z.org.", "en", "b", 48),
        (6, "Other words under one number", "en", "b", 28),
        (None, "No number at all, but some words", None, None, 32),
        (None, "No number at all, but some words", None, None, 32),
        (None, None, None, None, None),
        (7, "日本語のテキスト и русский текст und deutsch \U0001d400\U0001f600", "xx", "c", None),
        (8, "\u0000 <|endoftext|> <|STARTOFTEXT|> á ÀB  x", "en", "c", 1),
        (9, LONG, "la", "c", len(LONG)),
        (10, "x" * 200_000, "en", "c", 200_000),
        (11, "7" * 100_000 + "@" + "." * 1000, "en", "c", 101_001),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    taken = "size bucket block fp rest key level h copies label start group ids text_hash held_out score _text _nth a b"
    return df.withColumns({name: F.lit("clash") for name in taken.split()})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

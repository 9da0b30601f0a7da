from __future__ import annotations

import random

import pytest

# Rows that every operator must take: nulls, empty and long texts, ties, repeated rows.
ODD = [
    (None, None, None, None, None),
    (None, "a text without an id, of more than ten words in all, you see", "en", "s", 1),
    (3, "", "en", None, 0),
    (4, " \t\n\r ", None, "s", 4),
    (5, "12345 67890 ++ --", "de", "s", 1),
    (6, "word", "de", "s", 1),
    (7, "the same row twice over, with more than ten words in it, as it is", "en", "s", 1),
    (7, "the same row twice over, with more than ten words in it, as it is", "en", "s", 1),
    (7, "another text with an id that was seen before, and ten words or so", "fr", "t", 1),
    (8, "ünïcödé 日本語 😀 ▁ \x00 and more of it, just to be on the safe side", "fr", "t", 1),
]


@pytest.fixture
def odd_rows(spark):
    """Documents of odd rows and one very long text, with columns whose names clash or need quotes."""
    draw = random.Random(5)
    long = " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 9))) for _ in range(40_000))
    rows = [*ODD, (9, long, "de", "u", len(long))]
    kinds = (
        "doc_id long, text string, lang string, source string, n_chars long, rid long, fp long, shard int, "
        "`a.b` string, block long, __id long, __key string, __spans string, kept_id long, c0 long"
    )
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4, 5, "y", "z", 6, 7) for r in rows], kinds)


@pytest.fixture
def no_rows(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

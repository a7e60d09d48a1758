from __future__ import annotations

import random

import pytest

LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, empty, blank and long texts, ties, repeated rows and clashing extra columns."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "a", 4),
        (4, LONG, "en", None, len(LONG)),
        (5, LONG, None, "a", len(LONG)),
        (6, "one", "de", "b", 3),
        (7, "one two", "de", "b", 7),
        (7, "one two", "de", "b", 7),
        (None, "an unnamed text of some words that says very little of use to any one", "en", "a", 70),
        (8, "ÀÉ ünïcode wörds \U0001f600 and a b 　 c", "fr", "c", 30),
    ]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return plain.selectExpr("*", "1 as n_words", "'x' as span", "2 as key", "3 as row", "4 as stratum", "5 as tokens", "6 as u", "7 as component_id", "8 as kept", "9 as content", "10 as n", "11 as doc", "12 as id", "13 as topic", "14 as base_failed")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture
def words():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(600)]
    return lambda n, r=rng: [r.choice(vocabulary) for _ in range(n)]

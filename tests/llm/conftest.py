import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with the operators' own."""

    def make(rows):
        full = [(i, t, "en" if i is None or i % 2 else None, "s", 0, 1.0, "x", True, 7, "k", "t") for i, t in rows]
        return spark.createDataFrame(full, COLUMNS + ", score double, labels string, kept boolean, _id int, _key string, _text string")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, odd characters."""
    rng = random.Random(5)
    long = " ".join(words(rng, 60_000, 5_000)) + "\n" + "y" * 5_000
    same = " ".join(words(rng, 80))
    return [
        (1, None), (2, ""), (3, " \n\t \x0b"), (4, long), (5, same), (5, same), (6, same), (None, same), (None, None),
        (7, "Één woord \u0085 ▁ \U0001f600 a\x00b   CC BY"), (8, "x"), (9, "\n\n\n"), (10, same.upper()),
    ]

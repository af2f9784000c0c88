import random

import pytest

FIELDS = "text string, lang string, doc_id long, source string, n_chars long, _n long, _salt string, id string, key string, kept string, _row string"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with further columns of awkward names and nulls in them."""

    def make(*pairs):
        rows = [(text, None, doc_id, None, None, 7, "s", "i", "k", "no", "r") for doc_id, text in pairs]
        return spark.createDataFrame(rows, FIELDS)

    return make


def prose(seed, words, vocabulary=400):
    """Invented words, the same for the same seed."""
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture(scope="session")
def text_of():
    return prose

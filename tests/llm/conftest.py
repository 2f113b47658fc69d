import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents of given texts, numbered from 0."""

    def make(texts, lang="en", source="s"):
        return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)], SCHEMA)

    return make


@pytest.fixture
def prose():
    rng = random.Random(7)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(600)]
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


#: What every operator must take: null, empty, blank, one word, unusual characters, a long text, repeated rows.
ODD = [None, "", "   \n\t ", "word", "é中😀  x", "a b c d e " * 4000, "same text here", "same text here"]


@pytest.fixture
def odd(docs):
    return docs(ODD)

import random

import pytest

#: A text of every odd kind: null, empty, blank, one word, all white space there is, signs, other scripts.
ODD = [None, "", " \n\t", "one", "a b\x0bc\x0cd\re\n\nf", "é ß 漢字 \U0001f600 x", "#*$%&|<>", "The the THE the the", "  no break"]


@pytest.fixture(scope="session")
def prose():
    """Texts of a small made-up vocabulary; with one seed always the same."""
    def make(seed, words):
        dice = random.Random(seed)
        stock = ["".join(dice.choices("abcdeö", k=dice.randint(1, 6))) for _ in range(60)]
        return " ".join(dice.choices(stock, k=words))

    return make


@pytest.fixture
def documents(spark):
    """(doc_id, text, lang, source) rows -> documents, with columns named like those that operators add."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), "mine", 7) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, kept string, size int").repartition(3)

    return make


@pytest.fixture
def odd_rows():
    """Odd texts with ids, one id null, one row twice, one id with two texts."""
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD)]
    return [*rows, (None, "null id", None, None), rows[3], (3, "other text of an id", "en", "s")]

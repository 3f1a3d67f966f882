import random

import pytest

LETTERS = "abcdefghijklmnop"


@pytest.fixture(scope="session")
def words():
    """An invented vocabulary."""
    chance = random.Random(5)
    return ["".join(chance.choice(LETTERS) for _ in range(chance.randint(2, 8))) for _ in range(400)]


@pytest.fixture
def prose(words):
    def make(n: int, seed: int) -> str:
        chance = random.Random(seed)
        return " ".join(chance.choice(words) for _ in range(n))

    return make


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang) as a table with further columns that clash with names of the operators' own."""

    def make(*rows):
        schema = "doc_id long, text string, lang string, key long, fp string, seed string, score double, shard string, peek string, piece string, n_chars long"
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", 1, "f", "s", 0.5, "h", "p", "i", len(r[1] or "")) for r in rows], schema)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path

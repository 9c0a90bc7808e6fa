import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string, hits int, class long"


def make_text(rng, words, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(words))


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randint(2, 8))) for _ in range(900)]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, lang), with further columns whose names operators also use."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", len(r[1] or ""), 0.5, "x", 1, 2) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows(vocabulary):
    """NULL and empty texts, blanks, a very long text, one long word, repeated rows, ties, rows without id."""
    rng = random.Random(5)
    plain = make_text(rng, 60, vocabulary)
    return [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, plain, "en"), (4, plain, "en"), (5, plain, "fr"),
        (6, make_text(rng, 30_000, vocabulary), "en"), (7, "x" * 50_000, "fr"), (8, "\n\n".join([plain] * 3), "fr"),
        (None, plain, "en"), (None, None, None), (9, "12345 67890 ½", "en"), (10, "ẞİÉ 中文 \U0001f600", "fr"),
        (11, "a b c d", "en"), (12, "a b c d", "fr"),
    ]

"""Fixtures of the training-data operators: awkward documents that every operator must take."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
BASE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank"

#: null and empty texts, white space alone, ties, repeated rows, null keys, a very long text, odd characters.
AWKWARD = [
    (1, BASE, "en", "b", 5), (2, BASE, "en", "b", 5), (2, BASE, "en", "b", 5), (3, None, "en", "a", None),
    (4, "", None, None, 0), (5, " \t\n ", "de", "a", 3), (6, LONG, "en", "a", 1), (7, "Überall straße café ΑΒΓ 中国 🙂", "de", "c", 1),
    (None, BASE + " and more", "en", "b", 1), (None, "lonely words without any id", None, "c", 1), (8, "one", "fr", "", 1),
    (9, "one", "fr", None, 1), (10, "a\nb\na\nb\nc c c", "fr", "a", 1), (11, "\x00\x1f <|endoftext|> it's 'S don't", "en", "z", 9),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward documents, with extra columns whose names operators use themselves."""
    rows = [(*r, "x", 1, 2.0, True) for r in AWKWARD]
    return spark.createDataFrame(rows, DOC_SCHEMA + ", fp string, size int, score double, w boolean")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)

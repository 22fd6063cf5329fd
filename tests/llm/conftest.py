import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"

LONG_TEXT = "the long words of a very long text and its end " * 8000


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns whose names clash with inner ones."""
    rows = [
        (1, "The cat of the house is on the mat. " * 9, "en", "a"),
        (1, "The cat of the house is on the mat. " * 9, "en", "a"),
        (2, None, None, None), (None, "a null id with some words in it, the last of them", "en", None),
        (3, "", "fr", "b"), (4, " \t\n\x0b\f\r ", "fr", "b"), (5, LONG_TEXT, "en", "a"),
        (6, "one", None, "a"), (7, "😀 naïve İ Σ words\nline two\nline two", "de", "c"), (None, None, None, None),
    ]
    names = "n_words long, key string, h long, fp long, line string, id long, length long, tokens long, kept boolean, " \
            "drop_lines string, kept_id long, mix_tokens long, in_0 string, sigs string, budget long, range int, weight long"
    extra = (9, "x", 1, 2, "y", 3, 4, 5, True, "z", 6, 7, "w", "v", 8, 1, 2)
    return spark.createDataFrame([(i, t, l, s, None if t is None else len(t), *extra) for i, t, l, s in rows],
                                 DOCUMENTS + ", " + names)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)

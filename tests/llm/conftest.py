import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words array<string>, rank int, score double"


@pytest.fixture(scope="module")
def make(spark):
    """Documents from (doc_id, text, lang, source), with extra columns whose names operators use themselves."""

    def frame(rows):
        return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), ["x"], 1, 0.5) for i, t, lang, s in rows], SCHEMA)

    return frame


@pytest.fixture
def odd(make):
    """Nulls in every column, empty and white-space texts, repeated rows, ties and one long text."""
    long = " ".join(f"w{i % 9000}" for i in range(60_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "same text here", "en", "b"), (4, "same text here", "en", "b"),
            (5, "same text here", "en", "b"), (6, long, "en", "a"), (None, "no id at all", None, "c"), (None, None, None, None), (7, "ünï €\x0b東京 ???", "fr", "a")]
    return make(rows)

import pytest

CLASHING = "point component id key tie start size number taken found redacted score features x label doc class spans".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHING
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *(f"{c}!" for c in CLASHING))


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with many more columns, whose names operators might use themselves."""

    def make(rows):
        return spark.createDataFrame([row(*r) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{i % 997}x{i // 997}" for i in range(60_000))
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n", None, "a"),
        (4, "one", "en", None),
        (5, "one", "en", "b"),
        (5, "one", "en", "b"),
        (None, "a text without an id", "de", "b"),
        (None, "a text without an id", "de", "b"),
        (6, long_text, "en", "a"),
        (7, long_text, "en", "c"),
        (8, "é ü ñ 123 !?", "fr", "c"),
        (9, "12345 67890 ...", "fr", "c"),
    ]


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])

import pytest

WORDS = "the of and to in red blue ship sea wind stone light field river house tree".split()

#: Rows that every operator must take: nulls, empty and blank texts, repeated rows, ties, one long text, odd characters.
ODD = [
    (1, None, None), (2, "", "en"), (3, " \t\n ", "en"), (4, "one", "en"), (5, "one two", None), (6, "Same text here", "en"), (7, "Same text here", "en"), (7, "Same text here", "en"),
    (8, "same TEXT here", "en"), (9, "é ü　日本語 🙂 \x1c ²½", "de"), (10, "word " * 30_000, "en"), (11, "x" * 50_000, "en"), (None, "an id that is null", "en"), (None, None, None),
    (12, "a\nb\r\nc  d\te'll we're <|endoftext|> 12345 ...", "en"), (2**40, "far id", "en"), (-5, "negative id", "en"), (13, "same text here\n", "fr"),
]
#: Extra columns named as the operators name their own.
SCHEMA = "doc_id bigint, text string, lang string, id bigint, digest string, v int, key string, size int, shard int, x string, n bigint"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(*r, 1, "d", 2, "k", 3, 4, "x", 5) for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, rows, parts=4):
    """rows: (doc_id, text)."""
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)

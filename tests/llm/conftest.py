import pytest

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "doc long, text_key long, row string, score double, token string, key long"
)
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))


def rows():
    """Nulls, empty and very long texts, ties, repeated rows and columns with clashing names."""
    texts = [
        (1, "Alpha beta gamma delta epsilon zeta eta theta"), (2, None), (3, ""), (4, " \t\n"), (5, "one two"),
        (6, "one two"), (7, LONG), (8, LONG + " end"), (9, "Alpha beta gamma delta epsilon zeta eta theta"),
        (9, "Alpha beta gamma delta epsilon zeta eta theta"), (10, "other text under one id"), (10, "a second text under it"),
        (None, "Alpha beta gamma delta epsilon zeta eta theta"), (None, "without an id"), (11, "ΑΣ é́ ''\"\" 東京  x"),
        (12, "THE MIT LICENSE and the mit license, CC-BY."), (13, 'api_key = "abcdef0123456789abcdef0123456789"'),
    ]
    return [
        (i, t, [None, "en", "fr"][k % 3], [None, "hot", "hot"][k % 3], None, 1, 2, "r", 0.5, "t", 3)
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)

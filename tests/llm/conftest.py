import pytest

LONG = "very long text " * 20_000


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    rows = [
        (1, "", "en", "s", 0),
        (2, None, None, None, None),
        (None, "no id here at all, only these words", "en", "s", 1),
        (3, LONG, "en", "s", 2),
        (4, LONG, "en", "t", 2),
        (5, "one two three four five six", "en", "s", 3),
        (5, "one two three four five six", "en", "s", 3),
        (6, "ONE TWO three four five six", "en", None, 3),
        (7, "two\x0bwords", "en", "s", 3),
        (8, "日本語 🎉 é x\n\n\n", "xx", "u", 4),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ("row", "mark", "sig", "node", "n", "low", "high", "kind", "spans", "score", "nth", "block", "slot", "starts", "place")
    for name in extra:
        frame = frame.selectExpr("*", f"'clash' AS `{name}`")
    return frame


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)

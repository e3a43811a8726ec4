import pytest

LONG = "lorem ipsum dolor sit amet consectetur " * 30_000  # over a megabyte in one text


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and extra columns whose names clash
    with those the operators make."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog again.", "en", "a"),
        (2, "The quick brown fox jumps over the lazy dog again.", "en", None),
        (3, None, "en", "b"), (4, "", "de", "c"), (5, " \n\t ", None, "d"), (6, "12345 %%% 678", "fr", "a"),
        (7, LONG, "en", "b"), (8, "one two", None, None), (None, "a text without any id at all", "en", "a"),
        (None, None, None, None), (9, "Ünï çödé ßtraße 你好 世界 \U0001f600", "de", "b"), (10, "one two", "en", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("n_chars", "line", "n_hit", "train", "g", "bucket", "score", "label", "shard", "row", "length", "tokens"):
        df = df.selectExpr("*", f"cast(7 as int) as {name}")
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")

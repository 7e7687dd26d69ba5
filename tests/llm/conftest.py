import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls everywhere, empty and long texts, repeated rows, columns with clashing names."""
    long = "the end of the long line goes on and on " * 4000
    rows = [
        (1, "Hello  wörld, it's\n2024!", "en", "a", 5, "x"),
        (1, "Hello  wörld, it's\n2024!", "en", "a", 5, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "b", 0, None),
        (None, "no id here", None, "b", 1, "y"),
        (5, " \n\t ", "fr", None, 2, "z"),
        (6, long, "en", "a", len(long), "z"),
        (7, "½ Ⅷ _x \x1c 日本語 'll 'tis", "xx", "c", 9, "z"),
        (8, "\U0001f600" * 50, "xx", "c", 9, "z"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, score long, key string"
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")

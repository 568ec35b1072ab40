import pytest


@pytest.fixture(scope="session")
def docs(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    """(id, text) of the smallest input."""
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, id string, label string, key int, class long, at int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and
    columns whose names the operators use themselves."""
    long_text = "the quick brown fox " * 20_000
    rows = [(1, "a b c d e f g h", "en", "s"), (1, "a b c d e f g h", "en", "s"), (2, "", "en", None), (3, None, None, None), (None, "a b c d e f g h", "en", "s"),
            (4, long_text, "en", "s"), (5, " \n\t ", None, "s"), (6, "un deux", "fr", "s"), (7, "un deux", "fr", "s"), (8, "!!! 123", "fr", "s"), (None, None, "fr", "s")]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 7, "x", "y", 1, 2, 3) for r in rows], ODD_SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)

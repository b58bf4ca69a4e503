import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and blank texts, ties, repeated rows and a long text.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", "en", "a", 4),
    (4, "one", "en", "b", 3),
    (4, "one", "en", "b", 3),
    (5, "one", "en", "b", 3),
    (6, "Ünïcode wörds, and 'quoted' text 12 34!\nline two", "de", "ü", 50),
    (None, "no id here at all", "en", "a", 17),
    (7, "word " * 30_000, "en", "c", 150_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with a column whose name clashes with names that operators use."""
    rows = [(*r, i, "x") for i, r in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS + ", score long, part string")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

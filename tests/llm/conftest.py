import pytest

SF0001 = "/root/testdata/sf0.001"

# Rows every text operator must survive: (doc_id, text, lang, source, n_chars, extra column).
EDGE_ROWS = [
    (1, None, "en", "s", None, 0),
    (2, "", None, "s", 0, 0),
    (3, "   \t\n ", "en", None, 6, 1),
    (4, "one", "en", "s", 3, 1),
    (4, "one", "en", "s", 3, 1),
    (None, "a text without an id", "en", "s", 20, 2),
    (5, "same words here again and again in this text", "en", "s", 44, 2),
    (6, "same words here again and again in this text", "de", "s", 44, 2),
    (7, "Ünï cödé 你好 \U0001f600   <|endoftext|> l'eau", "fr", "s", 30, 3),
    (8, "long " * 30_000, "en", "s", 150_000, 3),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and a column whose name an operator uses too."""
    return spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")

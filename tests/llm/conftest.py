import pytest

from rumbo.llm.common import deploy


@pytest.fixture(scope="session")
def llm(spark):
    deploy(spark)
    return spark


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, shard int, `__b` int, `key` string"
LONG = "lorem ipsum dolor sit amet " * 6000


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, 0.5, 1, 1, 1, "k"),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, 0.5, 1, 1, 1, "k"),
        (2, "the quick brown fox jumps over the lazy dog", "en", "b", 43, None, None, None, None, None),
        (3, None, None, None, None, None, None, None, None, None),
        (4, "", "en", "a", 0, 0.0, 0, 0, 0, ""),
        (5, " \t\n\r ", "en", "a", 5, 0.0, 0, 0, 0, ""),
        (6, LONG, "la", "c", len(LONG), 0.0, 0, 0, 0, ""),
        (7, "Ünïcode ☃ 𝄞 naïve\n\nline two", "fr", "", 27, 0.0, 0, 0, 0, ""),
        (None, "a row without an id", "en", "a", 19, 0.0, 0, 0, 0, ""),
        (None, None, None, None, None, None, None, None, None, None),
    ]
    return llm.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(llm, sf_dir):
    return llm.read.parquet(f"{sf_dir}/documents.parquet")

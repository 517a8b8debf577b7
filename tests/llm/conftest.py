import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, ids binary, cell long"
ODD = [None, "", " \n ", "a", "é ß ΣΑΣ İ 😀", "<|endoftext|> x <|startoftext|>", "word " * 9_000, "x" * 30_000, "</turn>: \\b \\l ### ok"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing column names."""
    rows = [(i, t, None, None, None, "s", b"x", 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[3], (None, "null id", "en", "s", 1, None, None, None)], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

import pytest

SF = "/root/testdata/sf0.001"

#: Null and empty texts, ties, repeated rows, odd white space, a long unsplit text, and special strings.
ODD = [
    (1, None), (2, ""), (3, "a"), (4, "  two  spaces \n and\tlines "), (5, "same text here"), (5, "same text here"), (5, "another text"),
    (None, "no id"), (None, None), (6, "naïve Ünïcödé ẞ İ é  x   y"), (7, "<|endoftext|> x<|endoftext|>y <|startoftext|>it's 2024"),
    (8, "x" * 30000 + " tail"), (9, "αβγ" * 5000 + "'s1" * 3000 + " \U0001f600\U0001f468‍\U0001f469"), (10, "word " * 3000), (11, "́combining first"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Texts of every awkward kind, with columns whose names may clash with an operator's own."""
    rows = [(i, t, "k", 1, 2.0, "s") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n int, score double, block string").repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("false")

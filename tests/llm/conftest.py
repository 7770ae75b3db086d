import pytest

#: Columns of documents, and some that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, node int, ids string, score double, __digest int, label string"

LONG = "long winded " * 20_000 + "end"


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    texts = [
        (1, "Some Words that are long enough to be shingled by four or five words each"),
        (2, "some words THAT are long enough to be shingled by four or five words each"),
        (2, "some words THAT are long enough to be shingled by four or five words each"),
        (None, "some words that are long enough to be shingled by four or five words each"),
        (3, None), (4, ""), (5, "   \n\t "), (6, LONG), (7, LONG), (8, "one"), (9, "ONE"), (10, "é ü ñ 日本語 🎉 \u0000 ▁"), (None, None), (11, "x" * 5000),
    ]
    rest = [("en", "a"), (None, "b"), ("de", None)]
    return [(i, t, *rest[n % 3], None if n % 2 else 7, "clash", 3, None, 0.5, 1, None) for n, (i, t) in enumerate(texts)]


@pytest.fixture
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]

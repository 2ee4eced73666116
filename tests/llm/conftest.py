import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not there")
    return SMALL


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, a null id, and columns that clash with results and internals."""
    long = " ".join(f"w{i}" for i in range(6000))
    texts = [None, "", "  \n\t ", "one", "the same short text of words", "the same short text of words", long, long + " end"]
    rows = [(i, t, "x", i, 0.5, "k", 7) for i, t in enumerate(texts)]
    rows += [(None, "without an id", None, None, None, None, None), (4, "the same short text of words", "x", 4, 0.5, "k", 7)]
    schema = "doc_id long, text string, lang string, n_chars long, score double, shard string, sequence_id int"
    return spark.createDataFrame(rows, schema)

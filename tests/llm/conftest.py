import pytest
from pyspark.sql import SparkSession

from salesmart.llm.common import importable

EDGE = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, kept string, lane string, payload string"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


def edge_rows():
    """Nulls, empty, white, very long, tied and repeated rows, with extra columns whose names operators use inside."""
    long = "".join(f"word{i % 977} " for i in range(30_000)) + "end."
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "One two."), (5, "ONE two."), (6, "One two."), (6, "One two."),
        (None, "One two."), (None, None), (7, long), (8, long.upper()), (9, "ÄÖ ß é\x1c\x85x"), (10, "a" * 5000),
        (11, "İ ſ K \U0001f600 中文"), (12, None), (12, None),
    ]
    return [(i, t, None if n % 3 == 0 else "en", None, None, n, "x", "y", None) for n, (i, t) in enumerate(texts)]


@pytest.fixture
def edge(spark: SparkSession):
    return spark.createDataFrame(edge_rows(), EDGE)


@pytest.fixture
def empty(spark: SparkSession):
    return spark.createDataFrame([], EDGE)


@pytest.fixture(scope="session")
def docs(spark: SparkSession):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

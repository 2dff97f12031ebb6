import pytest

from macrospark.llm.common import ready


@pytest.fixture(autouse=True)
def workers(spark):
    """Python workers import the package from here."""
    ready(spark)


#: Nulls, empty texts, ties, repeated rows, and columns whose names the operators use themselves.
ODD_ROWS = [
    (1, "one two three four five six", "x", 1),
    (1, "one two three four five six", "x", 1),
    (2, "one two three four five six", None, 2),
    (3, None, "y", None),
    (4, "", "y", 4),
    (None, "a text without a key", "z", 5),
    (None, "a text without a key", "z", 5),
    (5, "word " * 30_000, "long", 6),
    (6, "?!", "signs", 7),
    (7, "Ünïcödé wörds àre kept whöle", "u", 8),
]
ODD_DDL = "doc_id long, text string, node string, key int"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_DDL)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], ODD_DDL)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from macrospark.session import get_spark

    session = get_spark("local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a small frame from rows and DDL, and read one back as tuples."""

    def make(data, ddl):
        return spark.createDataFrame(data, ddl)

    return make

"""Small literal tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def inline_table(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """A table of literals whose size Spark knows, so that joins to it are broadcast."""
    schema = T.StructType.fromDDL(ddl)
    columns = zip(*rows) if rows else [[] for _ in schema]
    return spark.createDataFrame(pa.table({f.name: list(c) for f, c in zip(schema, columns)}), schema)

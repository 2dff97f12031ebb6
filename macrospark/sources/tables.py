"""Table scans, view registration and JDBC."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Rows per round trip of a JDBC read and of a JDBC write.
JDBC_FETCH_SIZE = 10_000
JDBC_BATCH_SIZE = 1_000


def read_table(spark: SparkSession, path: str, format: str = "parquet", **options: Any) -> DataFrame:
    """All rows below a path; folders named ``column=value`` become partition columns.

    Files in other folders count too. A path that has both kinds of folders is
    refused, since rows of one kind would lack columns of the other.
    """
    reader = spark.read.format(format).options(**options)
    try:
        found = reader.load(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        found = None  # no file at the top
    deep = spark.read.format(format).options(**options, recursiveFileLookup="true")
    if found is None:
        return deep.load(path)
    whole = deep.schema(found.schema).load(path)
    if set(whole.inputFiles()) == set(found.inputFiles()):
        return found
    plain = deep.load(path)
    if set(found.columns) - set(plain.columns):
        raise ValueError(f"{path} has files outside its column=value folders")
    return plain


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def register_tables(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """A view per name; a path that does not exist is skipped with a warning."""
    registered = []
    for name, path in paths.items():
        try:
            register_view(read_table(spark, path), name)
            registered.append(name)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            log.warning("no table at %s, view %s skipped", path, name)
    return registered


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition: tuple[str, Any, Any, int] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; ``partition`` is (column, lower, upper, number of parallel reads)."""
    options = {"url": url, "dbtable": table, "fetchsize": str(JDBC_FETCH_SIZE)}
    options |= {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v}
    if partition:
        column, lower, upper, count = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(count),
        }
    return options


def read_jdbc(spark: SparkSession, **kwargs: Any) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def jdbc_write_options(url: str, table: str, **kwargs: Any) -> dict[str, str]:
    options = jdbc_options(url, table, **kwargs)
    del options["fetchsize"]
    return options | {"batchsize": str(JDBC_BATCH_SIZE)}


def write_jdbc(df: DataFrame, mode: str = "overwrite", **kwargs: Any) -> None:
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(**kwargs)).save()

"""Landed JSON documents to raw record rows.

Documents are JSON lines: a line is one API answer, so a large landing folder
splits over tasks. ``multiline=True`` reads one document per file. Every
reader returns ``(records, quarantine)``; a document that cannot be read or
that reports an error goes to the second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark import schemas

_CORRUPT = "_corrupt_record"


def _landed(keep: Sequence[str]) -> list[Column]:
    """Columns of the document to hand on; points of a series have a year of their own."""
    return [F.col(c).alias(f"landed_{c}") for c in keep]


_LANDING = "indicator STRING, year INT, month INT, day INT"


def document_reader(reader, schema: str, multiline: bool = False):
    """A batch or stream reader of documents, set up for ``json(path)``."""
    declared = reader.schema(f"{schema}, {_LANDING}, {_CORRUPT} STRING")
    return declared.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).option("multiLine", multiline)


def read_documents(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """Landed documents with the folder's partition columns (``indicator`` and the day)."""
    return document_reader(spark.read, schema, multiline).json(path)


def _split(docs: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    reason = F.when(F.col(_CORRUPT).isNotNull(), "unreadable document").otherwise(error)
    judged = docs.withColumn("error", reason)
    return judged.filter("error is null"), judged.filter("error is not null").select("indicator", "error")


def fred_records(docs: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    good, bad = _split(docs, F.when(F.col("observations").isNull(), "no observations"))
    # folders are named by the series id in lower case
    rows = good.select(F.upper("indicator").alias("series_id"), *_landed(keep), F.inline("observations"))
    return rows, bad


def bea_records(docs: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    data, reported = F.coalesce("data", "BEAAPI.Results.Data"), F.col("BEAAPI.Results.Error")
    error = (
        F.when(F.col("data").isNull() & F.col("BEAAPI").isNull(), "no BEAAPI element")
        .when(reported.isNotNull(), reported)
        .when(data.isNull(), "no data")
    )
    good, bad = _split(docs, error)
    rows = good.select(
        F.coalesce("table_key", "indicator").alias("table_key"),
        *_landed(keep),
        F.inline(data),
    )
    return rows, bad


def bls_records(docs: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    found = F.coalesce("series", "Results.series")
    failed = F.col("series").isNull() & ~F.col("status").eqNullSafe("REQUEST_SUCCEEDED")
    error = F.when(
        failed,
        F.concat_ws(": ", F.coalesce("status", F.lit("no status")), F.nullif(F.array_join("message", "; "), F.lit(""))),
    ).when(found.isNull(), "no series")
    good, bad = _split(docs, error)
    series = good.select(*_landed(keep), F.inline(found))
    return series.select(F.col("seriesID").alias("series_id"), *[f"landed_{c}" for c in keep], F.inline("data")), bad


def read_fred_json(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    return fred_records(read_documents(spark, path, schemas.FRED_DOC, multiline))


def read_bea_json(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    return bea_records(read_documents(spark, path, schemas.BEA_DOC, multiline))


def read_bls_json(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    return bls_records(read_documents(spark, path, schemas.BLS_DOC, multiline))

"""Landed documents as a file stream, from the landing folder to the published mart.

The stream's checkpoint is the memory of what was read: a second run takes new
files only. Each micro-batch becomes one commit of the versioned table, which
knows batches by number, so a batch that is run again is written once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark import schemas
from macrospark.operators.dedupe import dedupe_latest
from macrospark.plans import incremental, normalize, refresh, staging
from macrospark.sources import dims, json_docs
from macrospark.sources.versioned import VersionedTable

LANDED = ("year", "month", "day")


@dataclass(frozen=True)
class DocumentSource:
    """How an agency's documents become rows of a versioned table."""

    schema: str
    records: Callable[..., tuple[DataFrame, DataFrame]]
    rows: Callable[[DataFrame, Column], tuple[DataFrame, DataFrame]]
    table: str


SOURCES = {
    "fred": DocumentSource(
        schemas.FRED_DOC, json_docs.fred_records,
        lambda records, at: normalize.normalize_fred(records, dims.fred_series_dim(records.sparkSession), at), "fred_observations",
    ),
    "bea": DocumentSource(
        schemas.BEA_DOC, json_docs.bea_records,
        lambda records, at: normalize.normalize_bea(records, dims.bea_line_dim(records.sparkSession), at), "bea_nipa_observations",
    ),
    "bls": DocumentSource(
        schemas.BLS_DOC, json_docs.bls_records,
        lambda records, at: normalize.normalize_bls(records, dims.bls_series_dim(records.sparkSession), at), "bls_observations",
    ),
}


def stream_documents(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """New documents of a landing folder, with its partition columns."""
    reader = json_docs.document_reader(spark.readStream, schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(path)


def ingest_documents(
    spark: SparkSession, landing: str, source: DocumentSource, root: str, checkpoint: str, max_files: int | None = None
) -> VersionedTable:
    """Merge what has landed since the last run; a row's vintage is the day its document landed.

    Documents that cannot be read go to ``root/quarantine``, a folder per batch.
    """
    spec = refresh.TABLES[source.table]

    def merge(batch: DataFrame, number: int) -> None:
        records, bad = source.records(batch, keep=LANDED)
        bad.write.mode("overwrite").parquet(f"{root}/quarantine/{source.table}/_batch={number}")
        day = [F.col(f"landed_{c}") for c in LANDED]
        rows, _ = source.rows(records, F.make_timestamp(*day, F.lit(0), F.lit(0), F.lit(0)))
        own = refresh.open_table(batch.sparkSession, spec, root)
        own.upsert(dedupe_latest(rows, spec.keys, spec.order), batch=f"{checkpoint}#{number}")

    stream = stream_documents(spark, landing, source.schema, max_files)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(merge).start().awaitTermination()
    return refresh.open_table(spark, spec, root)


def documents_to_mart(spark: SparkSession, landing: str, months: DataFrame, root: str, max_files: int | None = None) -> int:
    """One run from landed single-key documents to the published mart; returns the mart's version.

    Only new documents are read, and only the months they reach are rebuilt.
    """
    source = SOURCES["fred"]
    spec = refresh.TABLES[source.table]
    before = refresh.open_table(spark, spec, root).last_version()
    table = ingest_documents(spark, landing, source, root, f"{root}/checkpoints/{source.table}", max_files)
    changed = table.changes(before).select("series_id", "observation_date")
    return incremental.refresh_mart_increment(spark, staging.stage_fred(table.read()), changed, months, root)

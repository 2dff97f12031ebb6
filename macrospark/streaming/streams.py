"""Streams of new bronze rows into versioned tables, and live refresh counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from macrospark.operators import sketches
from macrospark.operators.dedupe import dedupe_latest, tie_columns
from macrospark.sources.versioned import VersionedTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New Parquet files of a folder or glob."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _timed(stream: DataFrame, at: str, delay: str) -> DataFrame:
    """Watermark on a time column; wall-clock times are taken as UTC whatever the session's zone."""
    moment = F.col(at).cast("timestamp")
    if isinstance(stream.schema[at].dataType, T.TimestampNTZType):
        moment = F.from_utc_timestamp(moment, F.current_timezone())
    return stream.withColumn(at, moment).withWatermark(at, delay)


def drop_replays(stream: DataFrame, keys: Sequence[str], at: str, delay: str, salts: int = 16) -> DataFrame:
    """First arrival of every key; a key is remembered until the watermark passes it.

    ``at`` is the time of loading, which trails by no more than ``delay``; a
    row behind the watermark is dropped. ``upsert_stream`` has no such limit.

    With ``salts`` (0 for none) the copies of a key are first thinned out in that many
    groups, so that a record sent over and over does not fill one task.
    """
    timed = _timed(stream, at, delay)
    if salts:
        timed = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        timed = timed.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark(list(keys))


def refreshed_by_window(stream: DataFrame, key: str, at: str, width: str = "2 hours", delay: str = "1 day") -> DataFrame:
    """Approximate number of distinct keys, and the rows, per tumbling window."""
    timed = _timed(stream, at, delay)
    return timed.groupBy(F.window(at, width)).agg(
        F.approx_count_distinct(key).alias("refreshed_keys"), F.count("*").alias("rows")
    )


def sketched_by_window(stream: DataFrame, key: str, at: str, width: str = "2 hours", delay: str = "1 day") -> DataFrame:
    """Rows and a mergeable sketch of the distinct keys per tumbling window, to be stored and rolled up."""
    return sketches.sketched(_timed(stream, at, delay), [F.window(at, width)], key)


def newest_changes(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A key's newest row whenever a micro-batch brings a newer one; for output mode ``update``.

    Keyed state holds the newest row of each key, for good. Rows compare by ``order`` and then
    by all other columns, so what is kept does not depend on how the rows were cut into
    batches; a late older vintage or a replayed row changes nothing and gives no row.
    Combined ahead of the shuffle, so a hot key, a null one included, sends one row a task.
    """
    if not order:
        raise ValueError("without an order no row is newer than another")
    others = [c for c in stream.columns if c not in keys]
    # the moment of a micro-batch is one value, recorded in the checkpoint: the same when it is run again
    arrived = stream.withColumn("_arrived", F.current_timestamp())
    ranked = F.struct(*order, *tie_columns(stream, keys, order), (-F.unix_micros("_arrived")).alias("_earliest"))
    newest = arrived.groupBy(*keys).agg(F.max_by(F.struct(*others, "_arrived"), ranked).alias("_newest"))
    changed = newest.filter(F.col("_newest._arrived") == F.current_timestamp())
    return changed.select(*[c if c in keys else F.col("_newest")[c].alias(c) for c in stream.columns])


def upsert_stream(
    stream: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    remember: bool = False,
) -> StreamingQuery:
    """Merge every micro-batch into a versioned table, with what is there now.

    The table's ``order`` says which of a key's rows is the newest, within a
    batch and across batches: an older one that arrives late does not win. A
    batch is reduced first, which combines ahead of its shuffle. The batch number goes into the commit, so a batch that is
    run again after a failure is written once.

    With ``remember`` the stream keeps each key's newest row as state (on disk, in
    RocksDB, since it grows with the keys), and a batch writes only the keys whose
    newest row it changed (``newest_changes``); for tables that only this stream
    writes to.
    """

    def merge(batch: DataFrame, number: int) -> None:
        # a batch plan is bound to the stream's own session
        own = VersionedTable(batch.sparkSession, table.path, table.keys, table.partition_by, table.order, table.buckets)
        # rows with a null key are reduced too: as a stream they may be replays
        rows = batch if remember else dedupe_latest(batch, table.keys, table.order)
        own.upsert(rows, batch=f"{checkpoint}#{number}")

    if not remember:
        writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return writer.foreachBatch(merge).start()
    changes = newest_changes(stream, table.keys, table.order)
    writer = changes.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER)
    conf.set(_PROVIDER, _ROCKSDB)  # a query takes its settings along when it starts
    try:
        return writer.outputMode("update").foreachBatch(merge).start()
    finally:
        conf.set(_PROVIDER, before)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder, with what is there now."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.format("parquet").outputMode("append").start(path)


def write_complete(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a folder at the whole current result of a streaming aggregate."""

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.outputMode("complete").foreachBatch(replace).start()

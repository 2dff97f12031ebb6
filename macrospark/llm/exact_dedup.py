"""Exact deduplication as a stateful stream.

The documents stream through a keyed state that never expires and lives on disk (RocksDB, with
snapshots in the checkpoint folder). Under each digest the state retains the stable identifier
of the document that stays, the locator of its content (file and row), and the number of
documents seen. The aggregation combines before its shuffle, so a digest with a third of all
rows sends one row per task. Another run over the same checkpoint takes new files only and goes
on from the state.

A digest only proposes: for every digest that was hit, the full bytes of its documents are
compared with the content the locator points to, and rows that differ are grouped by their bytes
instead. Singles are never read again.

Defined cases: a null text is an empty text; of equal texts the largest identifier stays, null
being the smallest, and of equal identifiers the last file and row; every input row comes back,
repeated ones too, with exactly one kept per text; an empty table gives an empty result; columns
beyond identifier and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark.llm.common import text_of, written
from macrospark.session import new_run_dir

#: Digests that were hit travel to the scan if they are no more than this (64 MB); beyond it, rows are shuffled to them.
BROADCAST_DIGESTS = 1_000_000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256_of(text: str) -> Column:
    return F.sha2(text_of(text), 256)


def _rows(df: DataFrame, key: str, text: str, digest) -> DataFrame:
    return df.select(
        F.col(key).alias("id"),
        text_of(text).alias("content"),
        digest(text).alias("digest"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def run_stream(spark: SparkSession, path: str, checkpoint: str, key: str, text: str, digest) -> None:
    """Feed all files that the checkpoint has not seen into the state, then stop."""
    session = spark.newSession()  # its settings are this stream's alone
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "400")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # no room set aside on disk
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    schema = spark.read.parquet(path).select(key, text).schema
    pattern = f"{path[:-1]}[{path[-1]}]"  # a pattern may stand for one file or for a folder
    stream = _rows(session.readStream.schema(schema).parquet(pattern), key, text, digest)
    state = stream.groupBy("digest").agg(
        F.max(F.struct("id", "file", "row")).alias("keeper"), F.count(F.lit(1)).alias("seen")
    )
    query = (
        state.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table: digest, id, file, row, seen."""
    state = spark.read.format("statestore").load(checkpoint)
    keeper, seen = state.schema["value"].dataType.names
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col(f"value.`{keeper}`.*"),
        F.col(f"value.`{seen}`").alias("seen"),
    )


def exact_dedup(
    spark: SparkSession,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    checkpoint: str | None = None,
    digest=sha256_of,
) -> DataFrame:
    """One row per document of the Parquet files below `path`: key, keep_id, group_size, kept, digest.

    `checkpoint` names the state to go on with; a new one is begun under the shared folder if
    none is given. The path must hold all documents of the state, old files included.
    """
    path = path.rstrip("/")
    checkpoint = checkpoint or new_run_dir(spark, "exact-dedup")
    run_stream(spark, path, checkpoint, key, text, digest)
    state = read_state(spark, checkpoint)
    rows = _rows(spark.read.parquet(path).select(key, text, "_metadata"), key, text, digest)

    hit = state.where("seen > 1").select(
        F.col("digest").alias("d"), F.col("file").alias("keep_file"), F.col("row").alias("keep_row")
    )
    small = hit.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    hits = rows.join(F.broadcast(hit) if small else hit, F.col("digest") == F.col("d"))
    retained = hits.where("file = keep_file and row = keep_row").select("d", F.col("content").alias("kept_content"))
    checked = hits.drop("d").join(retained, F.col("digest") == F.col("d"))
    # Rows whose bytes are not the retained ones: none, unless the digest collides.
    odd = checked.where(F.col("content") != F.col("kept_content")).select("id", "file", "row", "digest", "content")
    odd = written(odd, "exact-dedup-odd")
    odd_groups = odd.groupBy("digest", "content").agg(
        F.max(F.struct("id", "file", "row")).alias("keeper"), F.count(F.lit(1)).alias("seen")
    )
    odd_rows = (
        odd.alias("o")
        .join(odd_groups.alias("g"), ["digest", "content"])
        .select("digest", "o.id", "o.file", "o.row", F.col("keeper.id").alias("keep_id"), "seen", "keeper")
    )
    lost = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("odd"))
    agreed = state.join(lost, "digest", "left").select(
        "digest",
        F.struct("id", "file", "row").alias("keeper"),
        (F.col("seen") - F.coalesce("odd", F.lit(0))).alias("seen"),
    )
    plain = (
        rows.drop("content")
        .join(odd.select(F.col("file").alias("f"), F.col("row").alias("r")),
              (F.col("file") == F.col("f")) & (F.col("row") == F.col("r")), "left_anti")
        .join(agreed, "digest")
        .select("digest", "id", "file", "row", F.col("keeper.id").alias("keep_id"), "seen", "keeper")
    )
    return plain.unionByName(odd_rows).select(
        F.col("id").alias(key),
        "keep_id",
        F.col("seen").alias("group_size"),
        ((F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))).alias("kept"),
        "digest",
    )

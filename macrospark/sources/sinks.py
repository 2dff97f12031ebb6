"""Writers. A partitioned write is rebalanced first, so that a hot partition value
is split over tasks and a rare one does not get a file from every task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.functions.scalars import content_hash

DAY_COLUMNS = ("year", "month", "day")
DISPOSITIONS = ("append", "replace")


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def _stamped(df: DataFrame, day: date) -> DataFrame:
    """Layout columns; month and day keep two digits in folder names."""
    return df.withColumns(
        {"year": F.lit(f"{day.year}"), "month": F.lit(f"{day.month:02d}"), "day": F.lit(f"{day.day:02d}")}
    )


def new_documents(docs: DataFrame, archived: DataFrame | None = None) -> DataFrame:
    """One row per distinct payload and indicator that is not archived yet.

    Compared by the whole digest: eight hex digits, as used in names, collide
    at scale. Copies are dropped ahead of the shuffle.
    """
    hashed = docs.select(
        "indicator", "payload", F.md5("payload").alias("_md5"), content_hash("payload").alias("content_hash")
    )
    fresh = hashed.groupBy("indicator", "_md5").agg(
        F.min("payload").alias("payload"), F.min("content_hash").alias("content_hash")
    )
    if archived is not None:
        seen = archived.select("indicator", F.md5("payload").alias("_md5")).distinct()
        fresh = fresh.join(seen, ["indicator", "_md5"], "left_anti")
    return fresh.drop("_md5")


def archive_json(spark: SparkSession, docs: DataFrame, root: str, source: str, day: date) -> str:
    """Add documents (``indicator``, ``payload``) to ``root/raw/source``, JSON lines by indicator and day.

    Landing the same payload again on the same day adds nothing.
    """
    path = f"{root}/raw/{source}"
    layout = T.StructType.fromDDL("payload STRING, indicator STRING, year STRING, month STRING, day STRING")
    found = _exists(spark, path)
    archived = None
    if found:
        archived = spark.read.schema(layout).text(path).filter(
            (F.col("year") == f"{day.year}") & (F.col("month") == f"{day.month:02d}") & (F.col("day") == f"{day.day:02d}")
        )
    # a line break in JSON is mere layout (within a string it is escaped), but would end the line here
    lines = docs.withColumn("payload", F.regexp_replace("payload", r"[\r\n]+", " "))
    fresh = _stamped(new_documents(lines, archived).drop("content_hash"), day)
    partition_by = ["indicator", *DAY_COLUMNS]
    _balanced(fresh, partition_by).write.partitionBy(*partition_by).mode("append").text(path)
    return path


def archive_parquet(df: DataFrame, root: str, source: str, indicator: str, day: date) -> str:
    """Put a frame under ``root/processed/source/indicator``; the day's earlier content is replaced."""
    path = f"{root}/processed/{source}/{indicator}"
    writer = _stamped(df, day).write.partitionBy(*DAY_COLUMNS).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def load_raw(df: DataFrame, path: str, disposition: str = "append", format: str = "parquet") -> None:
    """Load into a raw table; raw tables are append logs and staging removes repeats."""
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {DISPOSITIONS}, not {disposition!r}")
    df.write.format(format).mode("append" if disposition == "append" else "overwrite").save(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV part files, each with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole table."""
    writer = _balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Give one result to several sinks, computing it once."""
    held = df.persist()
    try:
        for sink in sinks:
            sink(held)
    finally:
        held.unpersist()


def materialize(df: DataFrame, name: str, as_: str = "view", path: str | None = None) -> DataFrame:
    """Register a model as a view, or write it and register what was written."""
    if as_ not in ("view", "table"):
        raise ValueError(f"as_ must be 'view' or 'table', not {as_!r}")
    if as_ == "table":
        if path is None:
            raise ValueError("a table needs a path")
        write_parquet(df, path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    df.createOrReplaceTempView(name)
    return df


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)

"""What several operators of this package share: reading, materialising, and identity of texts."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark.session import new_run_dir


def ready(spark: SparkSession) -> None:
    """Let this machine's Python workers import the package from where the driver has it.

    On a cluster the package comes with the job (`--py-files`).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The frame after a write to the shared folder: cuts the lineage, and outlives any executor.

    Spark deletes a shuffle's files once the driver's JVM has collected the frames that made it.
    Each write asks for a collection, so that the files of the steps before do not pile up: ahead
    of it, when the frames of the step before are no longer held, and after it.
    """
    path = new_run_dir(df.sparkSession, label)
    df.sparkSession.sparkContext._jvm.System.gc()
    df.write.option("compression", compression).parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """A text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def node_of(column: str) -> Column:
    """128 bits that stand for a text: equal texts are one node."""
    return F.unhex(F.md5(text_of(column)))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


#: Rows of a slice, below the 2**16 texts that `words.shingles` can number.
SLICE_ROWS = 50_000


def pieces(batch: pa.RecordBatch, column: int, limit: int):
    """Cut a batch into slices of about `limit` text bytes, so that one slice's arrays stay small."""
    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > limit or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


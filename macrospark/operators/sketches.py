"""Distinct counts that can be stored and rolled up: one sketch per window, merged without a rescan.

The sketches are HyperLogLog with 2**``LOG_BUCKETS`` buckets: the relative
standard error is about 1.04 / sqrt(2**12), below 2 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12
STANDARD_ERROR = 1.04 / 2 ** (LOG_BUCKETS / 2)


def sketched(df: DataFrame, by: Sequence[str | Column], key: str, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """Rows and a sketch of the distinct keys of each group; null keys are not counted."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(key, log_buckets).alias("sketch"))


def rolled_up(sketches: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Sketches of finer groups merged to coarser ones; the rows they stand for are not read again."""
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_keys(sketches: DataFrame, name: str = "distinct_keys") -> DataFrame:
    """The estimates that the sketches give."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")

"""Row selection, splitting and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def between_periods(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; reaches the scan as a pushed filter."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    return df


def lookback(df: DataFrame, column: str, days: int, as_of: date) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return df.filter(F.col(column) >= F.date_sub(F.lit(as_of), days).cast(df.schema[column].dataType))


def select_series(df: DataFrame, column: str, ids: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*ids))


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that hold, and the others; an unknown verdict counts as not valid."""
    verdict = F.coalesce(valid, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column some frames lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unify(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """Projection to a common schema."""
    return df.select(*[c.alias(name) for name, c in mapping.items()])


def top_recent(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The newest ``n`` rows; ``order`` should end in a unique column."""
    return df.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(n)


def with_audit(df: DataFrame, column: str, at: Column | None = None) -> DataFrame:
    return df.withColumn(column, F.current_timestamp() if at is None else at)

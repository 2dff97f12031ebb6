"""Long-to-wide pivots and downsampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rank(order: Sequence[str]) -> Column:
    # A single scalar order keeps the buffer fixed-width, hence a hash aggregate.
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def pivot_wide(
    df: DataFrame,
    index: Sequence[str],
    key: str,
    value: str,
    columns: Mapping[str, str],
    order: Sequence[str],
) -> DataFrame:
    """One row per index, one column per listed series: its newest value by ``order``.

    The list of series is explicit, so no job runs to discover it and the
    other series are dropped at the scan. One aggregate fills all columns:
    a pivot would group by index and series first, with a shuffle of its own.
    """
    listed = df.filter(F.col(key).isin(*columns))
    series, rank = F.col(key), _rank(order)
    newest = [F.max_by(value, F.when(series == k, rank)).alias(c) for k, c in columns.items()]
    return listed.groupBy(*index).agg(*newest)


def pivot_last(
    df: DataFrame,
    index: Sequence[str],
    key: str,
    value: str,
    columns: Mapping[str, str],
    order: Sequence[str],
) -> DataFrame:
    """``pivot_wide`` of the last non-null value; an index with no value at all has no row."""
    return pivot_wide(df.filter(F.col(value).isNotNull()), index, key, value, columns, order)


def resample_last(
    df: DataFrame,
    by: Sequence[str],
    date: str,
    value: str,
    grain: str,
    order: Sequence[str],
    period: str = "period",
) -> DataFrame:
    """Last non-null value of every entity in every week, month, quarter or year."""
    known = df.filter(F.col(value).isNotNull())
    start = F.trunc(F.col(date).cast("date"), grain) if grain != "day" else F.col(date).cast("date")
    return known.groupBy(*by, start.alias(period)).agg(F.max_by(value, _rank(order)).alias(value))

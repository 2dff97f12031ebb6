"""Aggregates over observations and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrospark.sources.inline import inline_table


def exact_avg(column: str, places: int) -> Column:
    """Mean rounded to ``places``.

    Summed in fixed point, so that row order does not matter; in floating
    point only if some value does not fit.
    """
    value = F.col(column).cast("double")
    fixed = value.try_cast("decimal(28,6)")
    exact = F.round(F.avg(fixed), places).cast("double")
    return F.when(F.count(fixed) == F.count(value), exact).otherwise(F.round(F.avg(value), places))


def annual_rollup(df: DataFrame, year: str, metrics: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Per year: the rounded mean of each metric (name -> column, places) and the number of rows."""
    means = [exact_avg(column, places).alias(name) for name, (column, places) in metrics.items()]
    return df.groupBy(year).agg(*means, F.count("*").alias("months"))


def series_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("observations"))


def refreshed_keys(df: DataFrame, key: str, at: str, since: Column, approximate: bool = False) -> DataFrame:
    """Number of distinct keys loaded since a moment."""
    count = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.filter(F.col(at) >= since).agg(count.alias("refreshed_keys"))


def non_null_ratio(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    known = F.count(column).cast("double") / F.count("*")
    return df.groupBy(*by).agg(known.alias("non_null_ratio"))


def missing_members(df: DataFrame, column: str, required: Sequence[str]) -> DataFrame:
    """Required values that never occur.

    The frame is first reduced to the required values it holds, so what is
    joined is never longer than the list.
    """
    wanted = inline_table(df.sparkSession, [(v,) for v in required], f"{column} string")
    seen = df.filter(F.col(column).isin(*required)).select(column).distinct()
    return wanted.join(seen, column, "left_anti")

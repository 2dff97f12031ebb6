"""Calendar spines and dense entity-by-period grids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: first month of the macro calendar.
SPINE_START = date(1990, 1, 1)

_STEP = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month",
         "quarter": "interval 3 months", "year": "interval 1 year"}


def _periods(start: Column, end: Column, grain: str) -> Column:
    first = start if grain == "day" else F.trunc(start, grain)
    return F.explode(F.sequence(first, end, F.expr(_STEP[grain])))


def spine(
    spark: SparkSession,
    start: date = SPINE_START,
    end: date | None = None,
    period: str = "observation_month",
    grain: str = "month",
) -> DataFrame:
    """Every period from ``start`` to ``end`` (today when not given)."""
    last = F.lit(end) if end else F.current_date()
    return spark.range(1).select(_periods(F.lit(start), last, grain).alias(period))


def spine_of(df: DataFrame, column: str, period: str = "observation_month", grain: str = "month") -> DataFrame:
    """Every period between the least and the greatest date of a column."""
    bounds = df.agg(F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("hi"))
    return bounds.filter("lo is not null").select(_periods(F.col("lo"), F.col("hi"), grain).alias(period))


def dense_grid(df: DataFrame, by: Sequence[str], period: str, grain: str = "month") -> DataFrame:
    """Every period of every entity, from its first to its last one.

    Each entity generates its own periods, so there is no cross join.
    """
    bounds = df.groupBy(*by).agg(F.min(period).cast("date").alias("_lo"), F.max(period).cast("date").alias("_hi"))
    return bounds.filter("_lo is not null").select(*by, _periods(F.col("_lo"), F.col("_hi"), grain).alias(period))


def densify(df: DataFrame, by: Sequence[str], period: str, grain: str = "month") -> DataFrame:
    """The rows of ``df``, one per entity and period, with the periods it skips added as nulls.

    Every row stretches up to the next one, so there is neither a grid nor a
    join, and a window over the same entities needs no further shuffle.
    """
    step = F.expr(_STEP[grain])
    ahead = F.lead(period).over(Window.partitionBy(*by).orderBy(period))
    last = F.coalesce((ahead - step).cast("date"), F.col(period))
    stretched = df.filter(F.col(period).isNotNull()).withColumn("_last", last)
    stretched = stretched.withColumn("_period", F.explode(F.sequence(F.col(period), "_last", step)))
    own = F.col("_period") == F.col(period)
    values = [F.when(own, F.col(c)).alias(c) for c in df.columns if c not in (*by, period)]
    return stretched.select(*by, F.col("_period").alias(period), *values)


def on_spine(calendar: DataFrame, wide: DataFrame, period: str) -> DataFrame:
    """A wide frame left-joined to the calendar, with year, month and quarter."""
    joined = calendar.join(wide, period, "left")
    return joined.select(
        period,
        F.year(period).alias("year"),
        F.month(period).alias("month"),
        F.trunc(period, "quarter").alias("quarter"),
        *[c for c in wide.columns if c != period],
    )

"""The monthly mart after an increment: only the months that changed observations reach are rebuilt.

A changed observation reaches its own month (a quarterly one the first month of
its quarter), the next month if a change from month to month is taken of it,
and the month twelve on if a yearly change is. These months, and the earlier
ones they are compared with, are all that is read of the staged series.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark.functions import scalars as S
from macrospark.operators import features
from macrospark.plans import marts, refresh
from macrospark.plans.marts import MACRO, MONTH, MartSpec

YEAR, NEXT = 12, 1


def _stands_on(spec: MartSpec, date: str = "observation_date") -> Column:
    """The month in which an observation stands in the mart."""
    month = F.trunc(date, "month")
    return F.when(F.col("series_id").isin(*spec.quarterly), F.trunc(date, "quarter")).otherwise(month) if spec.quarterly else month


def _shifted(months: DataFrame, by: Sequence[str], steps: Sequence[int]) -> DataFrame:
    """Each month, and those so many months away."""
    offsets = F.explode(F.array(*[F.lit(n) for n in sorted({0, *steps})])).alias("_n")
    moved = months.select(*by, MONTH, offsets).select(*by, F.add_months(MONTH, F.col("_n")).alias(MONTH))
    return moved.distinct()


def affected_periods(changed: DataFrame, spec: MartSpec = MACRO, by: Sequence[str] = ()) -> DataFrame:
    """The months of the mart that changed observations (``series_id``, ``observation_date``) reach."""

    def of(columns) -> list[str]:
        return [s for s, c in spec.series.items() if c in columns]

    listed = changed.filter(F.col("series_id").isin(*spec.series))
    steps = F.array(
        F.lit(0), F.when(F.col("series_id").isin(*of(spec.change)), NEXT), F.when(F.col("series_id").isin(*of(spec.yoy)), YEAR)
    )
    reached = listed.select(*by, _stands_on(spec).alias(MONTH), F.explode(F.array_compact(steps)).alias("_n"))
    return reached.select(*by, F.add_months(MONTH, F.col("_n")).alias(MONTH)).distinct()


def mart_rows(
    staged: DataFrame,
    months: DataFrame,
    only: DataFrame,
    spec: MartSpec = MACRO,
    by: Sequence[str] = (),
    updated_at: Column | None = None,
) -> DataFrame:
    """The rows of ``monthly_mart`` for the months ``only``, which lie on the calendar ``months``."""
    keys = [*by, MONTH]
    wanted = only.join(months, keys, "left_semi")
    back = [-NEXT] * bool(spec.change) + [-YEAR] * bool(spec.yoy)
    needed = _shifted(wanted, by, back).join(months, keys, "left_semi")
    near = staged.withColumn("_stands_on", _stands_on(spec)).join(
        needed.withColumnRenamed(MONTH, "_stands_on"), [*by, "_stands_on"], "left_semi"
    )
    wide = marts.wide_series(near.drop("_stands_on"), spec, by)

    def base(columns, steps: int, prefix: str) -> DataFrame:
        return wide.select(*by, F.add_months(MONTH, steps).alias(MONTH), *[F.col(c).alias(f"{prefix}{c}") for c in columns])

    rows = wanted.join(wide, keys, "left")
    rows = rows.join(base(spec.yoy, YEAR, "_year_"), keys, "left") if spec.yoy else rows
    rows = rows.join(base(spec.change, NEXT, "_last_"), keys, "left") if spec.change else rows
    parts = [
        *keys,
        F.year(MONTH).alias("year"),
        F.month(MONTH).alias("month"),
        F.trunc(MONTH, "quarter").alias("quarter"),
        *spec.series.values(),
        *[features.pct_of_base(F.col(c), F.col(f"_year_{c}")).alias(out) for c, out in spec.yoy.items()],
        *[(F.col(c) - F.col(f"_last_{c}")).alias(out) for c, out in spec.change.items()],
        S.complete_flag(spec.complete).alias("is_complete_record"),
    ]
    return rows.select(*parts, *([] if updated_at is None else [updated_at.alias("updated_at")]))


def refresh_mart_increment(
    spark: SparkSession,
    staged: DataFrame,
    changed: DataFrame,
    months: DataFrame,
    root: str,
    at: datetime | None = None,
    spec: MartSpec = MACRO,
) -> int:
    """Merge the months that changed, and months new to the calendar, into the published mart; returns the version.

    Without a published mart all months are new.
    """
    target = refresh.TABLES["macro_indicators_monthly"]
    table = refresh.open_table(spark, target, root)
    only = affected_periods(changed, spec)
    new = months.join(table.read().select(MONTH), MONTH, "left_anti") if table.exists() else months
    only = only.unionByName(new.select(MONTH)).distinct()
    return table.upsert(mart_rows(staged, months, only, spec), at)

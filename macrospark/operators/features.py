"""Change, padding and flag features over period-grain frames.

Offsets count rows. On a dense calendar (``calendar.on_spine``,
``calendar.densify``) rows are periods; on filtered rows they are not, and
both uses occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

NUMERIC = "decimal(28,6)"


def _ordered(by: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order)


def diff(col: str, n: int, by: Sequence[str], order: str) -> Column:
    """Value minus the value ``n`` rows earlier."""
    return F.col(col) - F.lag(col, n).over(_ordered(by, order))


def pct_of_base(now: Column, base: Column, scale: int = 2) -> Column:
    """Percentage change rounded half away from zero in decimal; null for a zero or unknown base."""
    change = F.lit(100.0) * (now - base) / F.nullif(base, F.lit(0.0))
    return F.round(change.try_cast(NUMERIC), scale)


def yoy_pct(col: str, by: Sequence[str], order: str, n: int = 12, scale: int = 2) -> Column:
    """Percentage change against ``n`` rows earlier, nulls not filled."""
    return pct_of_base(F.col(col), F.lag(col, n).over(_ordered(by, order)), scale)


def with_pct_change(
    df: DataFrame,
    col: str,
    out: str,
    n: int,
    by: Sequence[str],
    order: str,
    pad: bool = True,
    factor: float = 1.0,
) -> DataFrame:
    """Relative change against ``n`` rows earlier in floating point.

    ``pad`` carries the last known value over nulls first. A zero base gives
    an infinity of the value's sign, and null when the value is zero as well.
    """
    w = _ordered(by, order)
    held = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) if pad else F.col(col)
    now, base = F.col("_held"), F.col("_base")
    change = (
        F.when(base != 0, now / base - 1)
        .when(now > 0, F.lit(float("inf")))
        .when(now < 0, F.lit(float("-inf")))
    )
    return (
        df.withColumn("_held", held)
        .withColumn("_base", F.lag("_held", n).over(w))
        .withColumn(out, F.when(now.isNotNull() & base.isNotNull(), change * F.lit(factor)))
        .drop("_held", "_base")
    )


def with_quarter_change(df: DataFrame, col: str, out: str, by: Sequence[str], period: str) -> DataFrame:
    """Change between consecutive known quarters, given to all rows of the quarter.

    A row-offset difference cannot see it: quarterly values never stand in
    adjacent months.
    """
    quarter = F.trunc(period, "quarter").alias("_quarter")
    known = df.filter(F.col(col).isNotNull()).groupBy(*by, quarter).agg(F.max_by(col, period).alias("_value"))
    change = known.select(*by, "_quarter", diff("_value", 1, by, "_quarter").alias(out))
    return df.withColumn("_quarter", quarter).join(change, [*by, "_quarter"], "left").drop("_quarter")

"""Newest vintage per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERABLE = (T.MapType, T.VariantType)


def any_null(keys: Sequence[str]) -> Column:
    flag = F.lit(False)
    for key in keys:
        flag = flag | F.col(key).isNull()
    return flag


def null_spread(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """Extra join column that scatters rows with a null key.

    Such rows match nothing, yet they would all hash to one partition.
    """
    return F.when(any_null(keys), F.xxhash64(*columns)).otherwise(F.lit(0).cast("bigint"))


def tie_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> list[str]:
    """Every other column that has an order."""
    used = {*keys, *order}
    return [f.name for f in df.schema.fields if f.name not in used and not isinstance(f.dataType, _UNORDERABLE)]


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """One whole row per key, the greatest by ``order`` and then by ``tie``.

    ``tie`` defaults to every other column, so that the choice is the same on
    every run. Catalyst puts a group limit in front of the shuffle, hence a
    hot key sends one row per input partition.
    """
    if tie is None:
        tie = tie_columns(df, keys, order)
    ranking = [F.desc_nulls_last(c) for c in [*order, *tie]] or [F.asc(k) for k in keys]
    newest_first = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def latest_values(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``dedupe_latest`` for a few columns: no others are read or shuffled."""
    needed = df.select(*dict.fromkeys([*keys, *values, *order]))
    return dedupe_latest(needed, keys, order).select(*keys, *values)

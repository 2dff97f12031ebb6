"""Bronze to staging: newest vintage, types, period columns, missing flag.

The newest vintage wins even when its value is missing; filtering missing
values first would bring withdrawn numbers back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrospark.functions import scalars as S
from macrospark.operators.dedupe import dedupe_latest
from macrospark.operators.select import stack, unify

SERIES_KEY = ("series_id", "observation_date")
BEA_KEY = ("table_key", "series_name", "period_date")
VINTAGE = ("ingested_at",)


def _typed_date(df: DataFrame, column: str) -> Column:
    """A date column that may have been loaded as ISO text."""
    if df.schema[column].dataType.typeName() == "string":
        return S.normalize_date(column)
    return F.col(column).cast("date")


def _stage_series(bronze: DataFrame, flag: str, keep: Sequence[str], tie: Sequence[str] | None) -> DataFrame:
    typed = bronze.withColumn("observation_date", _typed_date(bronze, "observation_date"))
    newest = dedupe_latest(typed, SERIES_KEY, VINTAGE, tie)
    value = F.col("value").try_cast("double")
    return newest.select(
        "series_id",
        "observation_date",
        S.period_start("observation_date", "month").alias("observation_month"),
        S.period_start("observation_date", "quarter").alias("observation_quarter"),
        value.alias("value"),
        S.missing_flag(flag, value).alias("is_missing"),
        *[c for c in keep if c in bronze.columns],
    )


FRED_METADATA = ("description", "category", "units", "frequency", "source", "series_url", *VINTAGE, "pipeline_version")


def stage_fred(bronze: DataFrame, tie: Sequence[str] | None = None) -> DataFrame:
    return _stage_series(bronze, "value_is_missing", FRED_METADATA, tie)


def stage_bls(bronze: DataFrame, tie: Sequence[str] | None = None) -> DataFrame:
    return _stage_series(bronze, "is_missing", FRED_METADATA, tie)


def stage_bea(bronze: DataFrame, tie: Sequence[str] | None = None) -> DataFrame:
    typed = bronze.withColumn("period_date", _typed_date(bronze, "period_date"))
    value = F.col("value").try_cast("double")
    replaced = {"value": value, "is_missing": S.missing_flag("is_missing", value)}
    return dedupe_latest(typed, BEA_KEY, VINTAGE, tie).withColumns(replaced)


def unified_observations(*, fred: DataFrame, bea: DataFrame, bls: DataFrame) -> DataFrame:
    """One long table of three staged frames: source, series, date, value, missing flag and vintage.

    The frames are staged, so each key has its newest vintage; the vintage
    stays, so that newer rows can be told from these later.
    """

    def common(df: DataFrame, source: str, series: Column, date: str) -> DataFrame:
        mapping: Mapping[str, Column] = {
            "source": F.lit(source),
            "series_id": series,
            "observation_date": F.col(date),
            "value": F.col("value"),
            "is_missing": F.col("is_missing"),
            "ingested_at": F.col("ingested_at"),
        }
        return unify(df, mapping)

    return stack(
        [
            common(fred, "fred", F.col("series_id"), "observation_date"),
            common(bea, "bea", F.concat_ws(".", "table_key", "series_name"), "period_date"),
            common(bls, "bls", F.col("series_id"), "observation_date"),
        ]
    )

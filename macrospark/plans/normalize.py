"""Raw agency records to typed bronze rows.

Each function returns ``(rows, rejected)``; rejected records have a period
that cannot be read. Only one of the two costs anything if only one is used.

None of the marks for a missing value reads as a number, so the number parser
alone turns them into nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrospark.functions import scalars as S
from macrospark.operators.joins import lookup
from macrospark.operators.select import split_valid

# Fixed values.
PIPELINE_VERSION = "1.0.0"
FRED_SERIES_URL = "https://fred.stlouisfed.org/series/"
BLS_SERIES_URL = "https://data.bls.gov/timeseries/"
BLS_ANNUAL_AVERAGE = "M13"
UNKNOWN_SERIES = {"description": "", "category": "unknown", "units": ""}


def _audit(ingested_at: Column | None) -> list[Column]:
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return [at.alias("ingested_at"), F.lit(PIPELINE_VERSION).alias("pipeline_version")]


def normalize_fred(records: DataFrame, dim: DataFrame, ingested_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Records ``(series_id, date, value)``; a series without metadata gets defaults."""
    parsed = records.withColumns(
        {
            "observation_date": S.normalize_date("date"),
            "value": S.safe_double("value"),
        }
    )
    good, bad = split_valid(parsed, F.col("observation_date").isNotNull())
    rows = lookup(good, dim, ["series_id"], UNKNOWN_SERIES | {"frequency": ""})
    return (
        rows.select(
            "series_id",
            "observation_date",
            "value",
            F.col("value").isNull().alias("value_is_missing"),
            "description",
            "category",
            "units",
            "frequency",
            F.lit("fred").alias("source"),
            S.series_url("series_id", FRED_SERIES_URL).alias("series_url"),
            *_audit(ingested_at),
        ),
        bad,
    )


def normalize_bea(records: DataFrame, lines: DataFrame, ingested_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Records ``(table_key, LineNumber, TimePeriod, DataValue, ...)``; lines that are not mapped are dropped."""
    numbered = records.withColumn("bea_line_number", F.col("LineNumber").try_cast("int"))
    mapped = numbered.join(lines, ["table_key", "bea_line_number"]).withColumn(
        "period_date", S.parse_period_compact("TimePeriod", "frequency")
    )
    good, bad = split_valid(mapped, F.col("period_date").isNotNull())
    value = S.parse_thousands("DataValue")
    rows = good.withColumn("value", value).select(
        "table_key",
        "series_name",
        "period_date",
        "value",
        F.col("value").isNull().alias("is_missing"),
        "bea_table_name",
        "bea_line_number",
        F.coalesce("LineDescription", F.lit("")).alias("bea_line_description"),
        F.col("TimePeriod").alias("bea_period_str"),
        "frequency",
        F.coalesce("METRIC_NAME", F.lit("")).alias("units"),
        "description",
        F.lit("bea").alias("source"),
        *_audit(ingested_at),
    )
    return rows, bad.select(*records.columns)


def normalize_bls(records: DataFrame, dim: DataFrame, ingested_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Records ``(series_id, year, period, periodName, value, footnotes)``; annual averages are dropped."""
    points = records.filter(~F.col("period").eqNullSafe(BLS_ANNUAL_AVERAGE))
    dated = points.withColumn("observation_date", S.parse_period_coded("year", "period"))
    good, bad = split_valid(dated, F.col("observation_date").isNotNull())
    parsed = good.withColumn("value", S.safe_double("value"))
    defaults = UNKNOWN_SERIES | {"seasonal_adjustment": "", "survey": ""}
    rows = lookup(parsed, dim, ["series_id"], defaults)
    return (
        rows.select(
            "series_id",
            "observation_date",
            "value",
            F.col("value").isNull().alias("is_missing"),
            S.numeric_year("year").alias("year"),
            "period",
            F.coalesce("periodName", F.lit("")).alias("period_name"),
            S.join_codes("footnotes").alias("footnote_codes"),
            "description",
            "category",
            "units",
            F.coalesce("frequency", S.infer_frequency("period")).alias("frequency"),
            "seasonal_adjustment",
            "survey",
            F.lit("bls").alias("source"),
            S.series_url("series_id", BLS_SERIES_URL).alias("series_url"),
            *_audit(ingested_at),
        ),
        bad.select(*records.columns),
    )

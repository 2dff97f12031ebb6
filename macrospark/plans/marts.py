"""Wide monthly mart and what is computed from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrospark.functions import scalars as S
from macrospark.operators import calendar, features, pivot, quality, rollup
from macrospark.operators.joins import outer_merge

MONTH = "observation_month"
YEAR_ROWS = 12


@dataclass(frozen=True)
class MartSpec:
    """Which series become which columns and what is derived from them."""

    series: Mapping[str, str]
    quarterly: Sequence[str] = ()
    yoy: Mapping[str, str] = field(default_factory=dict)
    change: Mapping[str, str] = field(default_factory=dict)
    complete: Sequence[str] = ()


# The columns of the macro mart.
MACRO = MartSpec(
    series={
        "GDP": "gdp_billions_usd",
        "GDPC1": "real_gdp_billions",
        "CPIAUCSL": "cpi_all_urban",
        "CPILFESL": "core_cpi",
        "PCEPI": "pce_price_index",
        "PCEPILFE": "core_pce",
        "UNRATE": "unemployment_rate",
        "U6RATE": "u6_unemployment_rate",
        "PAYEMS": "nonfarm_payrolls_thousands",
        "CIVPART": "labor_force_participation_rate",
        "FEDFUNDS": "fed_funds_rate",
        "M2SL": "m2_money_supply_billions",
        "UMCSENT": "umich_consumer_sentiment",
        "INDPRO": "industrial_production_index",
        "HOUST": "housing_starts_thousands",
        "BOPGSTB": "trade_balance_millions",
    },
    quarterly=("GDP", "GDPC1"),
    yoy={"cpi_all_urban": "cpi_yoy_pct", "core_pce": "core_pce_yoy_pct"},
    change={"nonfarm_payrolls_thousands": "nonfarm_payrolls_mom_change"},
    complete=("cpi_all_urban", "unemployment_rate", "fed_funds_rate"),
)

# Two more series that derived features need.
EXTENDED = replace(
    MACRO,
    series={**MACRO.series, "T10Y2Y": "yield_curve_spread", "GDPPOT": "potential_gdp_billions"},
    quarterly=("GDP", "GDPC1", "GDPPOT"),
)

# Metric -> (mart column, decimal places).
ANNUAL_METRICS = {
    "avg_unemployment": ("unemployment_rate", 3),
    "avg_cpi_yoy": ("cpi_yoy_pct", 3),
    "avg_fed_funds": ("fed_funds_rate", 3),
    "avg_core_pce": ("core_pce_yoy_pct", 3),
    "avg_payrolls_mom": ("nonfarm_payrolls_mom_change", 0),
}

# The signal rule.
UNEMPLOYMENT_RISE = 0.5
SIGNAL_COLUMNS = (
    "cpi_yoy_pct",
    "core_pce_yoy_pct",
    "fed_funds_rate",
    "nonfarm_payrolls_mom_change",
)


def wide_series(staged: DataFrame, spec: MartSpec, by: Sequence[str] = ()) -> DataFrame:
    """One row per period with a column per series: its latest observation in the period.

    A quarterly series stands on the first month of its quarter and is not
    carried into the other two.
    """
    known = staged.filter(~F.col("is_missing"))
    month = F.col(MONTH)
    if spec.quarterly:
        month = F.when(F.col("series_id").isin(*spec.quarterly), F.col("observation_quarter")).otherwise(month)
    known = known.select(*by, month.alias(MONTH), "series_id", "value", "observation_date")
    return pivot.pivot_wide(known, [*by, MONTH], "series_id", "value", spec.series, ["observation_date"])


def monthly_mart(
    staged: DataFrame,
    months: DataFrame | None = None,
    spec: MartSpec = MACRO,
    by: Sequence[str] = (),
    updated_at: Column | None = None,
) -> DataFrame:
    """The mart on the calendar ``months``, or on every entity's own span of months."""
    wide = wide_series(staged, spec, by)
    joined = calendar.densify(wide, by, MONTH) if months is None else months.join(wide, [*by, MONTH], "left")
    derived = {out: features.yoy_pct(c, by, MONTH) for c, out in spec.yoy.items()}
    derived |= {out: features.diff(c, 1, by, MONTH) for c, out in spec.change.items()}
    parts = [
        *by,
        MONTH,
        F.year(MONTH).alias("year"),
        F.month(MONTH).alias("month"),
        F.trunc(MONTH, "quarter").alias("quarter"),
        *spec.series.values(),
        *[c.alias(out) for out, c in derived.items()],
        S.complete_flag(spec.complete).alias("is_complete_record"),
    ]
    if updated_at is not None:
        parts.append(updated_at.alias("updated_at"))
    return joined.select(*parts)


def annual_summary(mart: DataFrame, metrics: Mapping[str, tuple[str, int]] = ANNUAL_METRICS) -> DataFrame:
    """Yearly means over complete months."""
    return rollup.annual_rollup(mart.filter("is_complete_record"), "year", metrics).orderBy("year")


def _signals(mart: DataFrame, gdp_change, by: Sequence[str]) -> DataFrame:
    complete = gdp_change(mart.filter("is_complete_record"))
    rise = features.diff("unemployment_rate", 3, by, MONTH)
    measured = complete.select(
        *by,
        MONTH,
        "year",
        "real_gdp_billions",
        "gdp_qoq_change",
        "unemployment_rate",
        rise.alias("unemployment_3m_change"),
        *SIGNAL_COLUMNS,
    )
    rising = F.col("unemployment_3m_change") > UNEMPLOYMENT_RISE
    falling = F.col("gdp_qoq_change") < 0
    flag = F.when(rising & falling, True).otherwise(False)
    return measured.withColumn("recession_risk_flag", flag).filter(rising | falling)


def recession_signals(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Months with rising unemployment or falling output, by row offsets over complete months.

    Output is compared with the month before, where a quarterly series has no
    value: that leg never fires. ``recession_signals_by_quarter`` compares
    quarters.
    """
    change = features.diff("real_gdp_billions", 1, by, MONTH)
    return _signals(mart, lambda df: df.withColumn("gdp_qoq_change", change), by)


def recession_signals_by_quarter(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same rule with output compared between consecutive known quarters."""

    def by_quarter(df: DataFrame) -> DataFrame:
        return features.with_quarter_change(df, "real_gdp_billions", "gdp_qoq_change", by, MONTH)

    return _signals(mart, by_quarter, by)


# The columns of the macro summary, and the table its accounts come from.
SUMMARY_TABLE = "gdp_and_components"
SUMMARY_BEA = {"gdp": "gdp_billions", "personal_consumption_expenditures": "pce_billions"}
SUMMARY_FRED = {
    "CPIAUCSL": "cpi",
    "FEDFUNDS": "fed_funds_rate",
    "M2SL": "m2_billions",
    "T10Y2Y": "yield_curve_spread",
}


def macro_summary(
    *,
    bea: DataFrame,
    fred: DataFrame,
    bea_tie: Sequence[str] = (),
    fred_tie: Sequence[str] = (),
    bea_table: str = SUMMARY_TABLE,
) -> DataFrame:
    """Last known values of two sources by month, merged, with inflation and curve inversion.

    Series names recur in several accounts tables, so one table is read. Months that neither source has are absent, so the twelve-row change is not
    calendar-bound.
    """
    output = pivot.pivot_last(
        bea.filter(F.col("table_key") == bea_table).withColumn("month", F.trunc("period_date", "month")),
        ["month"], "series_name", "value", SUMMARY_BEA, ["period_date", *bea_tie],
    )
    money = pivot.pivot_last(
        fred.withColumn("month", F.trunc("observation_date", "month")),
        ["month"], "series_id", "value", SUMMARY_FRED, ["observation_date", *fred_tie],
    )
    merged = outer_merge(output, money, ["month"])
    changed = features.with_pct_change(merged, "cpi", "cpi_yoy_pct", YEAR_ROWS, [], "month", factor=100.0)
    return changed.withColumn("yield_curve_inverted", S.negative_flag("yield_curve_spread"))


def checked_summary(
    *, bea: DataFrame, fred: DataFrame, bea_table: str = SUMMARY_TABLE, as_of: Column | None = None, **ties: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The summary, and what its inputs must pass: rows, columns, known values, every series it needs, no date past ``as_of`` (today)."""
    as_of = F.current_date() if as_of is None else as_of
    accounts = bea.filter(F.col("table_key") == bea_table)
    report = quality.check_non_empty(accounts, bea_table)
    for check in (
        quality.check_non_empty(fred, "fred"),
        quality.check_columns(accounts, ["series_name", "period_date", "value"]),
        quality.check_columns(fred, ["series_id", "observation_date", "value"]),
        quality.check_non_null_ratio(accounts, "value"),
        quality.check_non_null_ratio(fred, "value"),
        quality.check_members(accounts, "series_name", list(SUMMARY_BEA)),
        quality.check_members(fred, "series_id", list(SUMMARY_FRED)),
        quality.check_no_future(accounts, "period_date", as_of),
        quality.check_no_future(fred, "observation_date", as_of),
    ):
        report = report.unionByName(check)
    return macro_summary(bea=bea, fred=fred, bea_table=bea_table, **ties), report


# National-accounts series that may join the mart, under their own names.
BEA_COLUMNS = (
    "gdp",
    "pce_total",
    "pce_goods",
    "pce_durable_goods",
    "pce_services",
    "pce_housing_utilities",
    "pce_healthcare",
    "personal_income",
    "wages_salaries",
    "personal_saving_rate",
    "current_account_balance",
    "goods_exports",
    "goods_imports",
    "services_exports",
    "services_imports",
)


def with_bea_columns(mart: DataFrame, staged_bea: DataFrame, names: Sequence[str] = BEA_COLUMNS) -> DataFrame:
    """The mart with national-accounts columns; each value stands on the first month of its period."""
    known = staged_bea.filter(~F.col("is_missing")).withColumn(MONTH, F.trunc("period_date", "month"))
    wide = pivot.pivot_wide(known, [MONTH], "series_name", "value", {n: n for n in names}, ["period_date"])
    return mart.join(wide, MONTH, "left")


def ratio(a: str, b: str) -> Column:
    return F.col(a) / F.nullif(F.col(b), F.lit(0.0))


def derived_features(mart: DataFrame, by: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Further indicators: those named, or else all whose columns are present.

    A named one that cannot be made is an error.
    """
    month = MONTH
    recipes = {
        "core_cpi_yoy_pct": (["core_cpi"], lambda: features.yoy_pct("core_cpi", by, month)),
        "real_fed_funds_rate": (
            ["fed_funds_rate", "cpi_yoy_pct"],
            lambda: F.col("fed_funds_rate") - F.col("cpi_yoy_pct").cast("double"),
        ),
        "yield_curve_inverted": (["yield_curve_spread"], lambda: S.negative_flag("yield_curve_spread")),
        "payrolls_mom_change_thousands": (
            ["nonfarm_payrolls_thousands"],
            lambda: features.diff("nonfarm_payrolls_thousands", 1, by, month),
        ),
        "pce_services_goods_ratio": (["pce_services", "pce_goods"], lambda: ratio("pce_services", "pce_goods")),
        "gdp_output_gap_proxy": (
            ["real_gdp_billions", "potential_gdp_billions"],
            lambda: F.lit(100.0) * (F.col("real_gdp_billions") - F.col("potential_gdp_billions"))
            / F.nullif(F.col("potential_gdp_billions"), F.lit(0.0)),
        ),
        # on the dense calendar the quarter before stands three rows up
        "real_gdp_qoq_pct": (["real_gdp_billions"], lambda: features.yoy_pct("real_gdp_billions", by, month, n=3)),
    }
    possible = [name for name, (needs, _) in recipes.items() if set(needs) <= set(mart.columns)]
    if names is not None and set(names) - set(possible):
        lacking = {n: sorted(set(recipes[n][0]) - set(mart.columns)) if n in recipes else "unknown" for n in set(names) - set(possible)}
        raise ValueError(f"these features cannot be made, for want of columns: {lacking}")
    return mart.withColumns({name: recipes[name][1]() for name in (possible if names is None else names)})

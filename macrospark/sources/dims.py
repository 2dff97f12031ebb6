"""Series metadata of the three agencies."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from macrospark.sources.inline import inline_table

# Series id | description | category | units | frequency.
FRED_SERIES = """
GDP | Gross Domestic Product | output | billions_usd | quarterly
GDPC1 | Real GDP (Chained 2017 Dollars) | output | billions_chained_2017_usd | quarterly
GDPPOT | Real Potential GDP | output | billions_chained_2012_usd | quarterly
CPIAUCSL | Consumer Price Index (All Urban Consumers) | inflation | index_1982_84_100 | monthly
CPILFESL | Core CPI (Excluding Food and Energy) | inflation | index_1982_84_100 | monthly
PCEPI | PCE Price Index | inflation | index_2017_100 | monthly
PCEPILFE | Core PCE Price Index (Fed's preferred measure) | inflation | index_2017_100 | monthly
UNRATE | Unemployment Rate | labor | percent | monthly
PAYEMS | Total Nonfarm Payroll Employment | labor | thousands_of_persons | monthly
CIVPART | Labor Force Participation Rate | labor | percent | monthly
U6RATE | U-6 Unemployment Rate (incl. underemployment) | labor | percent | monthly
FEDFUNDS | Effective Federal Funds Rate | monetary | percent | monthly
DGS10 | 10-Year Treasury Constant Maturity Rate | monetary | percent | daily
DGS2 | 2-Year Treasury Constant Maturity Rate | monetary | percent | daily
T10Y2Y | 10-Year minus 2-Year Treasury Spread (Yield Curve) | monetary | percent | daily
M2SL | M2 Money Supply | monetary | billions_usd | monthly
UMCSENT | University of Michigan Consumer Sentiment | sentiment | index_1966_q1_100 | monthly
INDPRO | Industrial Production Index | production | index_2017_100 | monthly
HOUST | Housing Starts | housing | thousands_of_units | monthly
MORTGAGE30US | 30-Year Fixed Rate Mortgage Average | housing | percent | weekly
BOPGSTB | Trade Balance: Goods and Services | trade | millions_usd | monthly
DEXUSEU | USD/EUR Exchange Rate | fx | usd_per_eur | daily
"""

# Table key | table code | frequency letter | description.
BEA_TABLES = """
gdp_and_components | T10105 | Q | GDP and major demand-side components (quarterly, $B SAAR)
real_gdp_growth | T10101 | Q | Real GDP percent change from preceding period (quarterly)
gdp_price_indexes | T10104 | Q | GDP chain-type price indexes (quarterly, 2017=100)
pce_by_category | T20805 | M | Personal Consumption Expenditures by category ($B SAAR)
personal_income_saving | T20600 | M | Personal income, disposable income, and saving
corporate_profits | T61600D | Q | Corporate profits by industry
international_transactions | T40100 | Q | Current account: trade, income, transfers (quarterly, $B)
fixed_assets | T50100 | A | Net stock of fixed assets (annual)
"""

# Table key | line number | series name.
BEA_LINES = """
gdp_and_components | 1 | gdp
gdp_and_components | 2 | personal_consumption_expenditures
gdp_and_components | 6 | gross_private_domestic_investment
gdp_and_components | 11 | net_exports_goods_services
gdp_and_components | 12 | exports
gdp_and_components | 16 | imports
gdp_and_components | 19 | government_consumption_investment
gdp_and_components | 20 | federal_government
gdp_and_components | 25 | state_local_government
real_gdp_growth | 1 | real_gdp_pct_change
real_gdp_growth | 2 | real_pce_pct_change
real_gdp_growth | 6 | real_gross_private_investment_pct_change
real_gdp_growth | 11 | real_net_exports_pct_change
real_gdp_growth | 19 | real_government_pct_change
gdp_price_indexes | 1 | gdp_price_index
gdp_price_indexes | 2 | pce_price_index
gdp_price_indexes | 9 | gross_private_investment_price_index
gdp_price_indexes | 13 | exports_price_index
gdp_price_indexes | 17 | imports_price_index
pce_by_category | 1 | pce_total
pce_by_category | 2 | pce_goods
pce_by_category | 3 | pce_durable_goods
pce_by_category | 6 | pce_nondurable_goods
pce_by_category | 10 | pce_services
pce_by_category | 11 | pce_housing_utilities
pce_by_category | 12 | pce_healthcare
pce_by_category | 17 | pce_financial_services
pce_by_category | 20 | pce_recreation
pce_by_category | 24 | pce_food_beverages
pce_by_category | 26 | pce_transportation
personal_income_saving | 1 | personal_income
personal_income_saving | 2 | compensation_of_employees
personal_income_saving | 3 | wages_salaries
personal_income_saving | 12 | proprietors_income
personal_income_saving | 16 | rental_income
personal_income_saving | 17 | personal_income_receipts_assets
personal_income_saving | 20 | transfer_payments
personal_income_saving | 27 | personal_outlays
personal_income_saving | 28 | personal_consumption_expenditures
personal_income_saving | 34 | personal_saving
personal_income_saving | 35 | personal_saving_rate
corporate_profits | 1 | corporate_profits_total
corporate_profits | 2 | domestic_industries_profits
corporate_profits | 3 | financial_sector_profits
corporate_profits | 13 | nonfinancial_sector_profits
corporate_profits | 30 | rest_of_world_profits
international_transactions | 1 | current_account_balance
international_transactions | 2 | goods_exports
international_transactions | 3 | goods_imports
international_transactions | 5 | services_exports
international_transactions | 6 | services_imports
international_transactions | 17 | primary_income_receipts
international_transactions | 18 | primary_income_payments
fixed_assets | 1 | net_stock_fixed_assets_total
fixed_assets | 2 | private_fixed_assets
fixed_assets | 3 | residential_fixed_assets
fixed_assets | 4 | nonresidential_fixed_assets
fixed_assets | 31 | government_fixed_assets
"""

# Series id | description | category | units | frequency | survey; all seasonally adjusted.
BLS_SERIES = """
CES0000000001 | Total Nonfarm Payrolls | labor | thousands_of_persons | monthly | Current Employment Statistics
LNS14000000 | Unemployment Rate (U-3) | labor | percent | monthly | Current Population Survey
LNS13327709 | U-6 Underemployment Rate (total unemployed + marginally attached + part-time for economic reasons) | labor | percent | monthly | Current Population Survey
CES0500000003 | Average Hourly Earnings, All Private Employees | labor | dollars_per_hour | monthly | Current Employment Statistics
CIU1010000000000A | Employment Cost Index, Wages and Salaries, All Workers | compensation | percent_change | quarterly | Employment Cost Index
CUSR0000SA0 | CPI-U All Items (Urban Consumers, Seasonally Adjusted) | inflation | index_1982_84_100 | monthly | Consumer Price Index
CUSR0000SA0L1E | Core CPI-U Excluding Food and Energy | inflation | index_1982_84_100 | monthly | Consumer Price Index
PRS85006092 | Nonfarm Business Productivity, Percent Change from Prior Quarter | productivity | percent_change | quarterly | Productivity and Costs
"""
BLS_ADJUSTMENT = "seasonally_adjusted"


@lru_cache(maxsize=None)
def rows_of(table: str) -> tuple[tuple[str, ...], ...]:
    return tuple(tuple(f.strip() for f in line.split(" | ")) for line in table.strip().splitlines())


def fred_series_dim(spark: SparkSession) -> DataFrame:
    return inline_table(
        spark,
        rows_of(FRED_SERIES),
        "series_id STRING, description STRING, category STRING, units STRING, frequency STRING",
    )


def bea_line_dim(spark: SparkSession) -> DataFrame:
    """One row per mapped line, with its table's code, frequency and description."""
    tables = {key: rest for key, *rest in rows_of(BEA_TABLES)}
    lines = [(key, int(line), name, *tables[key]) for key, line, name in rows_of(BEA_LINES)]
    return inline_table(
        spark,
        lines,
        "table_key STRING, bea_line_number INT, series_name STRING, "
        "bea_table_name STRING, frequency STRING, description STRING",
    )


def bls_series_dim(spark: SparkSession) -> DataFrame:
    rows = [(*most, BLS_ADJUSTMENT, survey) for *most, survey in rows_of(BLS_SERIES)]
    return inline_table(
        spark,
        rows,
        "series_id STRING, description STRING, category STRING, units STRING, frequency STRING, "
        "seasonal_adjustment STRING, survey STRING",
    )

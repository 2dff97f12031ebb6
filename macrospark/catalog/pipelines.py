"""Queries of staging, the marts, and what is computed from them."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from macrospark.catalog.base import (
    BEA, BLS, FRED, FRED_IDS, FRED_STAGED, LINE_KEY, LINE_TIES, MONTH_SPINE, SQL_NEWEST,
    bea_raw, bls_raw, fred_bronze, pick, query, sql_pick, table,
)
from macrospark.catalog.quality import _row, _zero
from macrospark.operators import calendar, dedupe
from macrospark.plans import incremental, marts, normalize, refresh, staging
from macrospark.session import new_run_dir
from macrospark.sources import dims, sinks
from macrospark.streaming import documents

TIE = ["record_id"]


# Newest vintage -----------------------------------------------------------------

@query(f"""
SELECT * EXCLUDE (rn, l_shipdate), CAST(l_shipdate AS DATE) AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_NEWEST}) AS rn FROM lineitem)
WHERE rn = 1""")
def dedupe_latest(spark, sf):
    newest = dedupe.dedupe_latest(table(spark, sf, "lineitem"), LINE_KEY, ["l_shipdate"], LINE_TIES)
    return newest.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query(f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_NEWEST}) AS rn FROM lineitem)
WHERE rn = 1""")
def latest_values(spark, sf):
    """Two columns of the newest row, as an aggregate."""
    return dedupe.latest_values(
        table(spark, sf, "lineitem"), LINE_KEY, ["l_extendedprice", "l_quantity"], ["l_shipdate", *LINE_TIES]
    )


@query("""
SELECT l_suppkey, l_linenumber, l_partkey, l_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_orderkey DESC, l_partkey DESC) AS rn
  FROM (SELECT DISTINCT l_suppkey, l_linenumber, l_partkey, l_orderkey FROM lineitem)) WHERE rn = 1""")
def dedupe_no_vintage(spark, sf):
    """Without a load time the other columns, in their order, decide."""
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_orderkey", "l_partkey")
    return dedupe.dedupe_latest(rows, ["l_suppkey", "l_linenumber"])


_BEA_NEWEST = """
newest AS (
  SELECT table_key, series_name, period_date, value, value IS NULL AS is_missing, frequency, bea_line_number, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY table_key, series_name, period_date
          ORDER BY ingested_at DESC, value DESC NULLS LAST) AS rn FROM bea WHERE period_date IS NOT NULL)
  WHERE rn = 1)"""


def _bea_bronze(spark, sf):
    rows, _ = normalize.normalize_bea(bea_raw(spark, sf), dims.bea_line_dim(spark), F.col("ingested_at"))
    return rows


def _bls_bronze(spark, sf):
    rows, _ = normalize.normalize_bls(
        bls_raw(spark, sf), dims.bls_series_dim(spark), F.col("ingested_at")
    )
    return rows


@query(f"WITH {BEA}, {_BEA_NEWEST} SELECT * EXCLUDE (ingested_at) FROM newest")
def dedupe_latest_composite(spark, sf):
    staged = staging.stage_bea(_bea_bronze(spark, sf), ["value"])
    return staged.select("table_key", "series_name", "period_date", "value", "is_missing", "frequency", "bea_line_number")


@query(f"WITH {FRED_STAGED} SELECT * EXCLUDE (record_id) FROM staged")
def staging_cast(spark, sf):
    staged = staging.stage_fred(fred_bronze(spark, sf), TIE)
    return staged.select("series_id", "observation_date", "observation_month", "observation_quarter", "value", "is_missing")


_UNITED = f"""
WITH {FRED}, {BEA}, {_BEA_NEWEST}, {BLS},
fred_newest AS (
  SELECT series_id, observation_date, value, coalesce(value_is_missing, value IS NULL) AS is_missing, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_date ORDER BY ingested_at DESC, record_id DESC) AS rn FROM fred)
  WHERE rn = 1),
bls_newest AS (
  SELECT series_id, observation_date, value, value IS NULL AS is_missing, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_date
          ORDER BY ingested_at DESC, value DESC NULLS LAST) AS rn FROM bls) WHERE rn = 1),
united AS (
SELECT 'fred' AS source, * FROM fred_newest
UNION ALL SELECT 'bea', table_key || '.' || series_name, period_date, value, is_missing, ingested_at FROM newest
UNION ALL SELECT 'bls', * FROM bls_newest)
SELECT * REPLACE (strftime(ingested_at, '%Y-%m-%d %H') AS ingested_at) FROM united"""


@query(_UNITED)
def unified_observations(spark, sf):
    """The newest vintages of all three agencies, BLS staged like the others."""
    united = staging.unified_observations(
        fred=staging.stage_fred(fred_bronze(spark, sf), TIE),
        bea=staging.stage_bea(_bea_bronze(spark, sf), ["value"]),
        bls=staging.stage_bls(_bls_bronze(spark, sf), ["value"]),
    )
    return united.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH"))


# The monthly mart ---------------------------------------------------------------

def _yoy(c: str, over: str = "ORDER BY observation_month") -> str:
    base = f"lag({c}, 12) OVER ({over})"
    return f"CAST(round(CAST(100.0 * ({c} - {base}) / nullif({base}, 0) AS DECIMAL(28,6)), 2) AS DOUBLE)"


_MART = FRED_STAGED + "," + MONTH_SPINE + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY observation_date DESC) AS rn
  FROM (SELECT *, CASE WHEN series_id IN ('GDP', 'GDPC1') THEN observation_quarter ELSE observation_month END AS period
        FROM staged WHERE NOT is_missing)),
wide AS (SELECT period, """ + ", ".join(
    f"max(value) FILTER (WHERE series_id = '{s}') AS {c}" for s, c in marts.MACRO.series.items()
) + """ FROM ranked WHERE rn = 1 GROUP BY period),
joined AS (SELECT s.month AS observation_month, w.* EXCLUDE (period) FROM spine s LEFT JOIN wide w ON w.period = s.month),
mart AS (
  SELECT observation_month, CAST(year(observation_month) AS INTEGER) AS year, CAST(month(observation_month) AS INTEGER) AS month,
    CAST(date_trunc('quarter', observation_month) AS DATE) AS quarter, """ + ", ".join(marts.MACRO.series.values()) + f""",
    {_yoy('cpi_all_urban')} AS cpi_yoy_pct, {_yoy('core_pce')} AS core_pce_yoy_pct,
    nonfarm_payrolls_thousands - lag(nonfarm_payrolls_thousands, 1) OVER (ORDER BY observation_month) AS nonfarm_payrolls_mom_change,
    cpi_all_urban IS NOT NULL AND unemployment_rate IS NOT NULL AND fed_funds_rate IS NOT NULL AS is_complete_record
  FROM joined)"""


def _mart(spark, sf, **extra):
    bronze = fred_bronze(spark, sf)
    months = calendar.spine_of(bronze, "observation_date")
    mart = marts.monthly_mart(staging.stage_fred(bronze, TIE), months, **extra)
    return mart.withColumns({c: F.col(c).cast("double") for c in marts.MACRO.yoy.values()})


@query(f"WITH {_MART} SELECT *, DATE '2024-01-31' AS updated_at FROM mart")
def monthly_mart(spark, sf):
    return _mart(spark, sf, updated_at=F.lit(datetime.date(2024, 1, 31)))


@query(f"WITH {_MART} SELECT * FROM mart")
def published_mart(spark, sf):
    """The mart merged into its versioned table, twice, and read back by year."""
    spec, root = refresh.TABLES["macro_indicators_monthly"], new_run_dir(spark, "marts")
    mart = _mart(spark, sf)
    refresh.run_table(spark, spec, mart, root, "overwrite")
    refresh.run_table(spark, spec, mart.filter("year >= 1998"), root)
    return refresh.open_table(spark, spec, root).read()


@query(f"WITH {_MART} SELECT * FROM mart")
def whole_refresh(spark, sf):
    """Two loads, each checked ahead of its merge, through raw log, versioned table and staging to the published mart."""
    spec, root = refresh.TABLES["fred_observations"], new_run_dir(spark, "whole-refresh")
    bronze = fred_bronze(spark, sf).withColumn("category", F.lit("all"))
    cut = F.lit("1995-06-01").cast(bronze.schema["ingested_at"].dataType)
    for load in (bronze.filter(F.col("ingested_at") < cut), bronze.filter(F.col("ingested_at") >= cut)):
        last = load.agg(F.max("ingested_at")).first()[0]
        staged, _ = refresh.refresh_source(
            spark, load, spec, root, lambda df: staging.stage_fred(df, TIE), last, gate=["freshness"], tie=TIE
        )
    mart, _ = refresh.refresh_mart(spark, staged, calendar.spine_of(bronze, "observation_date"), root)
    return mart.withColumns({c: F.col(c).cast("double") for c in marts.MACRO.yoy.values()})


@query(_UNITED)
def all_tables_refreshed(spark, sf):
    """Two loads of every agency's table, each merged and compacted; the tables staged and united."""
    root = new_run_dir(spark, "all-tables")
    bronze = {
        "fred_observations": fred_bronze(spark, sf).withColumn("category", F.lit("all")),
        "bea_nipa_observations": _bea_bronze(spark, sf).filter("period_date IS NOT NULL"),
        "bls_observations": _bls_bronze(spark, sf),
    }
    ties = {"fred_observations": TIE, "bea_nipa_observations": ["value"], "bls_observations": ["value"]}
    for early in (True, False):
        loads = {}
        for name, rows in bronze.items():
            cut = F.lit("1995-06-01").cast(rows.schema["ingested_at"].dataType)
            loads[name] = rows.filter(F.col("ingested_at") < cut if early else F.col("ingested_at") >= cut)
        refresh.refresh_all(spark, loads, root, compact=not early, ties=ties)
    fred, bea, bls = (refresh.open_table(spark, refresh.TABLES[name], root).read() for name in bronze)
    united = staging.unified_observations(
        fred=staging.stage_fred(fred, TIE), bea=staging.stage_bea(bea, ["value"]), bls=staging.stage_bls(bls, ["value"])
    )
    return united.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH"))


@query(f"""
WITH {_MART} SELECT year, {', '.join(
    f"CAST(round(avg(CAST({c} AS DECIMAL(28,6))), {n}) AS DOUBLE) AS {m}" for m, (c, n) in marts.ANNUAL_METRICS.items())},
  count(*) AS months FROM mart WHERE is_complete_record GROUP BY year""")
def annual_rollup(spark, sf):
    return marts.annual_summary(_mart(spark, sf))


@query(f"WITH {_MART} SELECT * FROM mart")
def incremental_mart(spark, sf):
    """A published mart of all observations loaded until 1998, then only the months that later loads reach."""
    root, bronze = new_run_dir(spark, "incremental"), fred_bronze(spark, sf).withColumn("category", F.lit("all"))
    months = calendar.spine_of(bronze, "observation_date")
    cut = F.col("ingested_at") >= F.lit("1998-01-01").cast(bronze.schema["ingested_at"].dataType)
    spec = refresh.TABLES["fred_observations"]
    table = refresh.open_table(spark, spec, root)
    for late in (~cut, cut):
        before = table.last_version()
        refresh.run_table(spark, spec, bronze.filter(late), root, tie=TIE)
        changed = table.changes(before).select("series_id", "observation_date")
        incremental.refresh_mart_increment(spark, staging.stage_fred(table.read(), TIE), changed, months, root)
    mart = refresh.open_table(spark, refresh.TABLES["macro_indicators_monthly"], root).read()
    return mart.withColumns({c: F.col(c).cast("double") for c in marts.MACRO.yoy.values()})


_DOC_FRED = f"""
fred AS (
  SELECT {sql_pick(FRED_IDS, 'o_custkey')} AS series_id, CAST(o_orderdate AS DATE) AS observation_date,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS value, CAST(NULL AS BOOLEAN) AS value_is_missing,
         o_orderkey % 2 AS ingested_at, CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_totalprice END AS record_id
  FROM orders)"""


@query(f"WITH {_MART.replace(FRED, _DOC_FRED)} SELECT * FROM mart")
def documents_mart(spark, sf):
    """From landed documents to the published mart, over two landings; the second run reads the new files only."""
    root, orders = new_run_dir(spark, "documents"), table(spark, sf, "orders")
    day, price = F.col("o_orderdate").cast("date").cast("string"), F.col("o_totalprice").cast("string")
    value = F.when(F.col("o_orderstatus") == "P", ".").otherwise(price)
    payload = F.format_string('{"observations":[{"date":"%s","value":"%s"}]}', day, value)
    docs = orders.select(F.lower(pick(FRED_IDS, F.col("o_custkey"))).alias("indicator"), payload.alias("payload"), "o_orderkey")
    months = calendar.spine_of(orders, "o_orderdate")
    for landing in (0, 1):
        fresh = docs.filter(F.col("o_orderkey") % 2 == landing).drop("o_orderkey")
        folder = sinks.archive_json(spark, fresh, root, "fred", datetime.date(2024, 1, 1 + landing))
        documents.documents_to_mart(spark, folder, months, root)
    mart = refresh.open_table(spark, refresh.TABLES["macro_indicators_monthly"], root).read()
    return mart.withColumns({c: F.col(c).cast("double") for c in marts.MACRO.yoy.values()})


@query(f"""
WITH {BLS} SELECT series_id, observation_date, value, value IS NULL AS is_missing
FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_date
        ORDER BY record_id % 2 DESC, value DESC NULLS LAST) AS rn FROM bls) WHERE rn = 1""")
def documents_labor(spark, sf):
    """Labour documents as a file stream into their refreshed table, two landings, several micro-batches."""
    root, raw = new_run_dir(spark, "documents-bls"), bls_raw(spark, sf)
    point = F.struct("year", "period", "periodName", "value", "footnotes")
    payload = F.to_json(F.struct(F.array(F.struct(F.col("series_id").alias("seriesID"), F.array(point).alias("data"))).alias("series")))
    docs = raw.select(F.lit("labor").alias("indicator"), payload.alias("payload"), "record_id")
    source = documents.SOURCES["bls"]
    for landing in (0, 1):
        fresh = docs.filter(F.col("record_id") % 2 == landing).drop("record_id")
        folder = sinks.archive_json(spark, fresh, root, "bls", datetime.date(2024, 1, 1 + landing))
        stored = documents.ingest_documents(spark, folder, source, root, f"{root}/checkpoint", max_files=4)
    return staging.stage_bls(stored.read()).select("series_id", "observation_date", "value", "is_missing")


_SIGNAL_COLUMNS = "observation_month, year, real_gdp_billions, gdp_qoq_change, unemployment_rate, unemployment_3m_change, " + ", ".join(
    marts.SIGNAL_COLUMNS
)
_SIGNAL_RULE = """
SELECT """ + _SIGNAL_COLUMNS + """,
  CASE WHEN unemployment_3m_change > 0.5 AND gdp_qoq_change < 0 THEN true ELSE false END AS recession_risk_flag
FROM signals WHERE unemployment_3m_change > 0.5 OR gdp_qoq_change < 0"""


@query(f"""
WITH {_MART}, signals AS (
  SELECT *, real_gdp_billions - lag(real_gdp_billions, 1) OVER (ORDER BY observation_month) AS gdp_qoq_change,
    unemployment_rate - lag(unemployment_rate, 3) OVER (ORDER BY observation_month) AS unemployment_3m_change
  FROM mart WHERE is_complete_record) {_SIGNAL_RULE}""")
def signal_rule_faithful(spark, sf):
    return marts.recession_signals(_mart(spark, sf))


@query(f"""
WITH {_MART}, quarters AS (
  SELECT q, value - lag(value, 1) OVER (ORDER BY q) AS gdp_qoq_change
  FROM (SELECT quarter AS q, arg_max(real_gdp_billions, observation_month) AS value
        FROM mart WHERE is_complete_record AND real_gdp_billions IS NOT NULL GROUP BY quarter)),
signals AS (
  SELECT m.*, gdp_qoq_change,
    unemployment_rate - lag(unemployment_rate, 3) OVER (ORDER BY observation_month) AS unemployment_3m_change
  FROM (SELECT * FROM mart WHERE is_complete_record) m LEFT JOIN quarters ON q = quarter) {_SIGNAL_RULE}""")
def signal_rule_corrected(spark, sf):
    return marts.recession_signals_by_quarter(_mart(spark, sf))


@query(f"""
WITH {FRED}, {BEA}, {_BEA_NEWEST},
output AS (
  SELECT month, max(value) FILTER (WHERE series_name = 'gdp') AS gdp_billions,
         max(value) FILTER (WHERE series_name = 'personal_consumption_expenditures') AS pce_billions
  FROM (SELECT *, row_number() OVER (PARTITION BY series_name, month ORDER BY period_date DESC) AS rn
        FROM (SELECT *, CAST(date_trunc('month', period_date) AS DATE) AS month FROM newest
              WHERE table_key = 'gdp_and_components' AND value IS NOT NULL AND series_name IN ('gdp', 'personal_consumption_expenditures')))
  WHERE rn = 1 GROUP BY month),
money AS (
  SELECT month, max(value) FILTER (WHERE series_id = 'CPIAUCSL') AS cpi, max(value) FILTER (WHERE series_id = 'FEDFUNDS') AS fed_funds_rate,
         max(value) FILTER (WHERE series_id = 'M2SL') AS m2_billions, max(value) FILTER (WHERE series_id = 'T10Y2Y') AS yield_curve_spread
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id, month ORDER BY observation_date DESC, record_id DESC) AS rn
        FROM (SELECT *, CAST(date_trunc('month', observation_date) AS DATE) AS month FROM fred
              WHERE value IS NOT NULL AND series_id IN ('CPIAUCSL', 'FEDFUNDS', 'M2SL', 'T10Y2Y')))
  WHERE rn = 1 GROUP BY month),
merged AS (SELECT coalesce(o.month, m.month) AS month, gdp_billions, pce_billions, cpi, fed_funds_rate, m2_billions, yield_curve_spread
           FROM output o FULL JOIN money m ON o.month = m.month),
held AS (SELECT *, last_value(cpi IGNORE NULLS) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING) AS h FROM merged)
SELECT * EXCLUDE (h), (h / lag(h, 12) OVER (ORDER BY month) - 1) * 100.0 AS cpi_yoy_pct,
       coalesce(yield_curve_spread < 0, false) AS yield_curve_inverted FROM held""")
def macro_summary(spark, sf):
    bea = staging.stage_bea(_bea_bronze(spark, sf), ["value"])
    return marts.macro_summary(bea=bea, fred=fred_bronze(spark, sf), fred_tie=TIE)


_GATE_DATE = "2001-06-30"


def _gates(name: str, series: str, date: str, required: dict) -> list[str]:
    """The rows of the checks of one input, from one row of its figures."""
    wanted = ", ".join(f"('{s}')" for s in required)
    figures = f"""(SELECT count(*) AS n, CAST(count(value) AS DOUBLE) / nullif(count(*), 0) AS ratio,
        (SELECT count(*) FROM (VALUES {wanted}) AS w(s) WHERE s NOT IN (SELECT {series} FROM {name})) AS absent,
        greatest(date_diff('day', DATE '{_GATE_DATE}', CAST(max({date}) AS DATE)), 0) AS ahead FROM {name})"""
    target = {"accounts": marts.SUMMARY_TABLE}.get(name, name)
    some = "CASE WHEN n > 0 THEN 'pass' ELSE 'fail' END"
    return [
        _row("non_empty", target, "CASE WHEN n > 0 THEN 1 ELSE 0 END", 1, some) + f" FROM {figures}",
        _row("non_null_ratio", "value", "ratio", 0.8, "CASE WHEN ratio > 0.8 THEN 'pass' ELSE 'fail' END") + f" FROM {figures}",
        _row("required_members", series, "absent", 0, _zero("absent")) + f" FROM {figures}",
        _row("no_future_dates", date, "ahead", 0, _zero("ahead")) + f" FROM {figures}",
        *[_row("required_column", c, "1", 1, "'pass'") for c in (series, date, "value")],
    ]


@query(f"WITH {FRED}, {BEA}, {_BEA_NEWEST}, accounts AS (SELECT * FROM newest WHERE table_key = '{marts.SUMMARY_TABLE}') "
       + " UNION ALL ".join(_gates("accounts", "series_name", "period_date", marts.SUMMARY_BEA)
                            + _gates("fred", "series_id", "observation_date", marts.SUMMARY_FRED)))
def summary_gates(spark, sf):
    """What the summary's inputs must pass, with a day that some dates lie beyond."""
    bea = staging.stage_bea(_bea_bronze(spark, sf), ["value"])
    as_of = F.lit(_GATE_DATE).cast("date")
    _, report = marts.checked_summary(bea=bea, fred=fred_bronze(spark, sf), as_of=as_of, fred_tie=TIE)
    return report


_EXTENDED = _MART.replace(
    "('GDP', 'GDPC1')", "('GDP', 'GDPC1', 'GDPPOT')"
).replace(
    "max(value) FILTER (WHERE series_id = 'GDP') ",
    "max(value) FILTER (WHERE series_id = 'T10Y2Y') AS yield_curve_spread, "
    "max(value) FILTER (WHERE series_id = 'GDPPOT') AS potential_gdp_billions, max(value) FILTER (WHERE series_id = 'GDP') ",
).replace(
    ", gdp_billions_usd,", ", yield_curve_spread, potential_gdp_billions, gdp_billions_usd,"
)


@query(f"""
WITH {_EXTENDED}, {BEA}, {_BEA_NEWEST},
accounts AS (SELECT period_date, max(value) FILTER (WHERE series_name = 'pce_services') AS pce_services,
               max(value) FILTER (WHERE series_name = 'pce_goods') AS pce_goods
             FROM newest WHERE NOT is_missing GROUP BY 1)
SELECT observation_month, {_yoy('core_cpi')} AS core_cpi_yoy_pct, fed_funds_rate - cpi_yoy_pct AS real_fed_funds_rate,
  coalesce(yield_curve_spread < 0, false) AS yield_curve_inverted,
  nonfarm_payrolls_mom_change AS payrolls_mom_change_thousands,
  pce_services / nullif(pce_goods, 0) AS pce_services_goods_ratio,
  100.0 * (real_gdp_billions - potential_gdp_billions) / nullif(potential_gdp_billions, 0) AS gdp_output_gap_proxy,
  {_yoy('real_gdp_billions').replace(', 12)', ', 3)')} AS real_gdp_qoq_pct
FROM mart LEFT JOIN accounts ON period_date = observation_month""")
def derived_features(spark, sf):
    mart = _mart(spark, sf, spec=marts.EXTENDED)
    mart = marts.with_bea_columns(mart, staging.stage_bea(_bea_bronze(spark, sf), ["value"]), ["pce_services", "pce_goods"])
    names = [
        "core_cpi_yoy_pct", "real_fed_funds_rate", "yield_curve_inverted", "payrolls_mom_change_thousands",
        "pce_services_goods_ratio", "gdp_output_gap_proxy", "real_gdp_qoq_pct",
    ]
    derived = marts.derived_features(mart, names=names)
    percent = {c: F.col(c).cast("double") for c in ("core_cpi_yoy_pct", "real_gdp_qoq_pct")}
    return derived.withColumns(percent).select("observation_month", *names)


_BEA_WIDE = ["gdp", "pce_goods", "personal_income", "current_account_balance", "goods_imports"]


@query(f"""
WITH {_MART}, {BEA}, {_BEA_NEWEST},
accounts AS (SELECT period_date, {', '.join(f"max(value) FILTER (WHERE series_name = '{n}') AS {n}" for n in _BEA_WIDE)}
             FROM newest WHERE NOT is_missing AND series_name IN ({', '.join(f"'{n}'" for n in _BEA_WIDE)}) GROUP BY 1)
SELECT m.observation_month, m.cpi_all_urban, m.gdp_billions_usd, {', '.join(_BEA_WIDE)}
FROM mart m LEFT JOIN accounts a ON a.period_date = m.observation_month""")
def mart_with_accounts(spark, sf):
    """The mart with columns of a second source."""
    mart = _mart(spark, sf).select("observation_month", "cpi_all_urban", "gdp_billions_usd")
    return marts.with_bea_columns(mart, staging.stage_bea(_bea_bronze(spark, sf), ["value"]), _BEA_WIDE)


# A mart per entity: the same plan with entity columns --------------------------------

ENTITY_SPEC = marts.MartSpec(
    series={"F": "finished", "O": "open", "P": "pending"},
    quarterly=("P",),
    yoy={"finished": "finished_yoy_pct"},
    change={"open": "open_mom_change"},
    complete=("finished", "open"),
)


@query("""
WITH obs AS (
  SELECT o_custkey, o_orderstatus AS series_id, CAST(o_orderdate AS DATE) AS day, o_totalprice AS value, o_orderkey,
         CAST(date_trunc(CASE o_orderstatus WHEN 'P' THEN 'quarter' ELSE 'month' END, o_orderdate) AS DATE) AS period FROM orders),
bounds AS (SELECT o_custkey, CAST(min(period) AS TIMESTAMP) AS lo, CAST(max(period) AS TIMESTAMP) AS hi FROM obs GROUP BY 1),
grid AS (SELECT o_custkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM bounds),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, series_id, period ORDER BY day DESC, o_orderkey DESC) AS rn FROM obs) WHERE rn = 1),
wide AS (SELECT o_custkey, period, max(value) FILTER (WHERE series_id = 'F') AS finished,
                max(value) FILTER (WHERE series_id = 'O') AS open, max(value) FILTER (WHERE series_id = 'P') AS pending
         FROM last GROUP BY 1, 2),
dense AS (SELECT g.o_custkey, g.month AS observation_month, finished, open, pending
          FROM grid g LEFT JOIN wide w ON w.o_custkey = g.o_custkey AND w.period = g.month)
SELECT *, """ + _yoy("finished", "PARTITION BY o_custkey ORDER BY observation_month") + """ AS finished_yoy_pct,
  open - lag(open, 1) OVER (PARTITION BY o_custkey ORDER BY observation_month) AS open_mom_change,
  finished IS NOT NULL AND open IS NOT NULL AS is_complete_record,
  CAST(year(observation_month) AS INTEGER) AS year, CAST(month(observation_month) AS INTEGER) AS month,
  CAST(date_trunc('quarter', observation_month) AS DATE) AS quarter
FROM dense""")
def entity_mart(spark, sf):
    """The mart of every customer on its own calendar."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderstatus").alias("series_id"), F.col("o_orderdate").cast("date").alias("observation_date"),
        F.col("o_totalprice").alias("value"), F.lit(False).alias("is_missing"), "o_orderkey",
    )
    newest = dedupe.dedupe_latest(orders, ["o_custkey", "series_id", "observation_date"], ["o_orderkey"], [])
    staged = newest.withColumns(
        {"observation_month": F.trunc("observation_date", "month"), "observation_quarter": F.trunc("observation_date", "quarter")}
    )
    mart = marts.monthly_mart(staged, None, ENTITY_SPEC, ["o_custkey"])
    return mart.withColumn("finished_yoy_pct", F.col("finished_yoy_pct").cast("double"))

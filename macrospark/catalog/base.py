"""Registry, and the agency-shaped views derived from the given tables.

orders stand for single-key series observations (the customer decides the
series), lineitem for table-and-line observations and for vintages of a key,
events for daily observations. Every view has a Spark form and an SQL form,
written independently of each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark.operators.dedupe import dedupe_latest
from macrospark.sources import dims

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


# Declared, so that no job opens a file to find a schema.
GIVEN = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf}/{name}.parquet")


def pick(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(number, F.lit(len(names))) + 1).cast("int"))


def sql_pick(names: list[str], number: str) -> str:
    return "[" + ",".join(f"'{n}'" for n in names) + f"][1 + {number} % {len(names)}]"


# Series names: every configured one, and some that have no metadata.
FRED_IDS = [r[0] for r in dims.rows_of(dims.FRED_SERIES)] + ["XDAILY", "XWEEKLY", "XYEARLY"]
BLS_IDS = [r[0] for r in dims.rows_of(dims.BLS_SERIES)] + ["XLABOR"]
BEA_KEYS = [r[0] for r in dims.rows_of(dims.BEA_TABLES)]
BEA_FREQUENCY = {r[0]: r[2] for r in dims.rows_of(dims.BEA_TABLES)}

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SERIES_COLUMNS = {p: c for p, c in zip(PRIORITIES, ["urgent", "high", "medium", "unspecified", "low"])}



def _status() -> Column:
    return F.col("o_orderstatus")


def _priority() -> Column:
    return F.col("o_orderpriority")


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


# Single-key series ------------------------------------------------------------

def fred_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Records as published: text dates, text values, '.' for a missing one."""
    missing = (_status() == "P") & _priority().isin("1-URGENT", "2-HIGH")
    return table(spark, sf, "orders").select(
        pick(FRED_IDS, F.col("o_custkey")).alias("series_id"),
        _day().cast("string").alias("date"),
        F.when(missing, ".").otherwise(F.col("o_totalprice").cast("string")).alias("value"),
        _loaded_at().alias("ingested_at"),
        F.col("o_orderkey").alias("record_id"),
    )


def _loaded_at() -> Column:
    hours = F.pmod("o_orderkey", F.lit(97)).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)


def fred_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The same records typed. Urgent or high and pending: no value; a low one leaves the flag
    open and a high one wrongly says that the value is there."""
    missing = (_status() == "P") & _priority().isin("1-URGENT", "2-HIGH")
    flag = F.when(_priority() != "5-LOW", missing & (_priority() != "2-HIGH"))
    return table(spark, sf, "orders").select(
        pick(FRED_IDS, F.col("o_custkey")).alias("series_id"),
        _day().alias("observation_date"),
        F.when(~missing, F.col("o_totalprice")).alias("value"),
        flag.alias("value_is_missing"),
        _loaded_at().alias("ingested_at"),
        F.col("o_orderkey").alias("record_id"),
    )


FRED = f"""
fred AS (
  SELECT {sql_pick(FRED_IDS, 'o_custkey')} AS series_id,
         CAST(o_orderdate AS DATE) AS observation_date,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
              ELSE o_totalprice END AS value,
         CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN false
              ELSE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' END AS value_is_missing,
         o_orderdate + to_hours(CAST(o_orderkey % 97 AS INTEGER)) AS ingested_at,
         o_orderkey AS record_id
  FROM orders)"""

FRED_STAGED = FRED + """,
staged AS (
  SELECT series_id, observation_date,
         CAST(date_trunc('month', observation_date) AS DATE) AS observation_month,
         CAST(date_trunc('quarter', observation_date) AS DATE) AS observation_quarter,
         value, coalesce(value_is_missing, value IS NULL) AS is_missing, record_id
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id, observation_date
                                     ORDER BY ingested_at DESC, record_id DESC) AS rn FROM fred)
  WHERE rn = 1)"""


# Table-and-line observations ----------------------------------------------------

def _bea_frequency() -> Column:
    key = pick(BEA_KEYS, F.col("l_suppkey"))
    return F.when(key == "fixed_assets", "A").when(key.isin("pce_by_category", "personal_income_saving"), "M").otherwise("Q")


def bea_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Records as published: numbers with separators, '(D)' for a withheld one, some periods unreadable."""
    day, frequency = F.col("l_shipdate"), _bea_frequency()
    year = F.year(day).cast("string")
    period = (
        F.when((F.col("l_quantity") == 50) & (F.col("l_returnflag") == "N"), "n/a")
        .when(frequency == "A", year)
        .when(frequency == "M", F.concat(year, F.lit("M"), F.lpad(F.month(day).cast("string"), 2, "0")))
        .otherwise(F.concat(year, F.lit("Q"), F.quarter(day).cast("string")))
    )
    withheld = (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0)
    return table(spark, sf, "lineitem").select(
        pick(BEA_KEYS, F.col("l_suppkey")).alias("table_key"),
        F.col("l_linenumber").cast("string").alias("LineNumber"),
        period.alias("TimePeriod"),
        F.when(withheld, "(D)").otherwise(F.format_number("l_extendedprice", 2)).alias("DataValue"),
        F.concat(F.lit("Line "), F.col("l_linenumber")).alias("LineDescription"),
        F.lit("Level").alias("METRIC_NAME"),
        F.col("l_shipdate").alias("ingested_at"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )


_LINES = ", ".join(f"('{k}', {n}, '{s}')" for k, n, s in dims.rows_of(dims.BEA_LINES))
_TABLES = ", ".join(f"('{k}', '{t}', '{f}')" for k, t, f, _ in dims.rows_of(dims.BEA_TABLES))
BEA = f"""
bea_lines(table_key, line_number, series_name) AS (VALUES {_LINES}),
bea_tables(table_key, table_name, frequency) AS (VALUES {_TABLES}),
bea AS (
  SELECT k.table_key, n.series_name, t.table_name AS bea_table_name, t.frequency, k.l_linenumber AS bea_line_number,
         CASE WHEN l_quantity = 50 AND l_returnflag = 'N' THEN NULL
              ELSE CAST(date_trunc(CASE t.frequency WHEN 'A' THEN 'year' WHEN 'M' THEN 'month' ELSE 'quarter' END,
                                   l_shipdate) AS DATE) END AS period_date,
         CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN NULL ELSE l_extendedprice END AS value,
         l_shipdate AS ingested_at, l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM (SELECT *, {sql_pick(BEA_KEYS, 'l_suppkey')} AS table_key FROM lineitem) k
  JOIN bea_lines n ON n.table_key = k.table_key AND n.line_number = k.l_linenumber
  JOIN bea_tables t ON t.table_key = k.table_key)"""


# Coded-period observations ------------------------------------------------------

def bls_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Records as published: year plus code, annual averages as M13, '-' for a missing value, footnotes."""
    series = pick(BLS_IDS, F.col("o_custkey"))
    quarterly = series.isin("CIU1010000000000A", "PRS85006092")
    code = (
        F.when((_status() == "P") & (_priority() == "3-MEDIUM"), "X01")
        .when(quarterly, F.concat(F.lit("Q0"), F.quarter("o_orderdate")))
        .when((_status() == "F") & (F.month("o_orderdate") == 12), "M13")
        .otherwise(F.concat(F.lit("M"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0")))
    )

    def note(value: str | None) -> Column:
        return F.struct(F.lit(value).cast("string").alias("code"))

    notes = F.when(_status() == "P", F.array(note("P"), note(None), note("R"))).when(_status() == "O", F.array(note("R"), note("")))
    return table(spark, sf, "orders").select(
        series.alias("series_id"),
        F.year("o_orderdate").cast("string").alias("year"),
        code.alias("period"),
        F.date_format("o_orderdate", "MMMM").alias("periodName"),
        F.when((_status() == "P") & (_priority() == "1-URGENT"), "-").otherwise(F.col("o_totalprice").cast("string")).alias("value"),
        notes.alias("footnotes"),
        _loaded_at().alias("ingested_at"),
        F.col("o_orderkey").alias("record_id"),
    )


BLS = f"""
bls AS (
  SELECT s.*, CASE WHEN quarterly THEN CAST(date_trunc('quarter', o_orderdate) AS DATE)
                   ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS observation_date,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS value,
         o_orderdate + to_hours(CAST(o_orderkey % 97 AS INTEGER)) AS ingested_at, o_orderkey AS record_id
  FROM (SELECT *, series_id IN ('CIU1010000000000A', 'PRS85006092') AS quarterly
        FROM (SELECT *, {sql_pick(BLS_IDS, 'o_custkey')} AS series_id FROM orders)) s
  WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM')
    AND NOT (NOT quarterly AND o_orderstatus = 'F' AND month(o_orderdate) = 12))"""


# Period-grain series ------------------------------------------------------------

def obs_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly totals of all orders per priority; the total of the low ones is known only in months with pending orders."""
    month = F.trunc(_day(), "month")
    sums = table(spark, sf, "orders").groupBy(_priority().alias("series_id"), month.alias("month"))
    totals = sums.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.count_if(_status() == "P").alias("pending"))
    known = (F.col("series_id") != "5-LOW") | (F.col("pending") > 0)
    return totals.select("series_id", "month", F.when(known, F.col("total").cast("double")).alias("value"))


MONTHLY = """
monthly AS (
  SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CASE WHEN o_orderpriority <> '5-LOW' OR count(*) FILTER (WHERE o_orderstatus = 'P') > 0
              THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) END AS value
  FROM orders GROUP BY 1, 2)"""

MONTH_SPINE = """
spine AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders))"""

MONTHLY_WIDE = MONTHLY + """,
wide AS (
  SELECT month, """ + ", ".join(
    f"max(value) FILTER (WHERE series_id = '{p}') AS {c}" for p, c in SERIES_COLUMNS.items()
) + " FROM monthly GROUP BY month)"


def obs_entity(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly totals per nation."""
    orders = table(spark, sf, "orders").select("o_custkey", _day().alias("day"), "o_totalprice")
    # totals per customer first: fewer rows meet the customers, and none of them is hot
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    per_customer = orders.groupBy("o_custkey", F.trunc("day", "month").alias("month")).agg(total.alias("part"))
    nations = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    joined = per_customer.join(nations, "o_custkey")
    return joined.groupBy("c_nationkey", "month").agg(F.sum("part").cast("double").alias("value"))


ENTITY = """
entity AS (
  SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""


# Vintages and the change log ----------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
SQL_NEWEST = "l_shipdate DESC, " + ", ".join(f"{c} DESC" for c in LINE_TIES)


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as yearly commits: the newest row per key and year."""
    lines = table(spark, sf, "lineitem").withColumn("_version", F.year("l_shipdate") - 1995)
    rows = dedupe_latest(lines, [*LINE_KEY, "_version"], ["l_shipdate"], LINE_TIES)
    committed = F.make_date(F.col("_version") + 1995, F.lit(12), F.lit(31)).cast("timestamp_ntz")
    return rows.select(*LINE_KEY, "l_quantity", "l_extendedprice", "_version", committed.alias("_committed_at"))


LOG = f"""
log AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, version, make_date(version + 1995, 12, 31) AS committed_at,
         CASE WHEN version = min(version) OVER (PARTITION BY l_orderkey, l_linenumber)
              THEN 'insert' ELSE 'update' END AS op
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, version ORDER BY {SQL_NEWEST}) AS rn
        FROM (SELECT *, CAST(year(l_shipdate) AS INTEGER) - 1995 AS version FROM lineitem))
  WHERE rn = 1)"""


def sql_state(condition: str, name: str) -> str:
    """SQL of the state after the log rows that meet a condition."""
    return f"""
{name} AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY version DESC) AS rn
        FROM log WHERE {condition})
  WHERE rn = 1)"""

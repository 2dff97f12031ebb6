"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrospark.catalog.base import fred_bronze, FRED, query, table
from macrospark.functions import scalars as S
from macrospark.functions.sql import register_functions
from macrospark.plans.normalize import FRED_SERIES_URL
from macrospark.sources.tables import register_view


@query("""
SELECT o_orderkey,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL
       ELSE CAST(date_trunc(CASE o_orderstatus WHEN 'F' THEN 'quarter' WHEN 'O' THEN 'month' ELSE 'year' END,
                            o_orderdate) AS DATE) END AS period_date
FROM orders""")
def parse_period_compact(spark, sf):
    day = F.col("o_orderdate")
    frequency = F.when(F.col("o_orderstatus") == "F", "Q").when(F.col("o_orderstatus") == "O", "M").otherwise("A")
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format(day, "'y'yy"))
        .when(frequency == "Q", F.concat(F.date_format(day, "yyyy'Q'"), F.quarter(day)))
        .when(frequency == "M", F.date_format(day, "yyyy'M'MM"))
        .otherwise(F.date_format(day, "yyyy"))
    )
    coded = table(spark, sf, "orders").select("o_orderkey", frequency.alias("frequency"), text.alias("period"))
    return coded.select("o_orderkey", S.parse_period_compact("period", "frequency").alias("period_date"))


_CODES = """
  CASE o_orderpriority
    WHEN '1-URGENT' THEN CASE WHEN o_orderstatus = 'P' THEN NULL ELSE date_trunc('month', o_orderdate) END
    WHEN '2-HIGH' THEN date_trunc('quarter', o_orderdate)
    WHEN '3-MEDIUM' THEN date_trunc('year', o_orderdate)
    WHEN '4-NOT SPECIFIED' THEN make_date(year(o_orderdate), CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 7 END, 1)
    ELSE date_trunc('month', o_orderdate) END"""


def _coded(spark, sf, *extra):
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    month = F.date_format(day, "MM")
    code = (
        F.when((priority == "1-URGENT") & (F.col("o_orderstatus") == "P"), "M13")
        .when(priority == "1-URGENT", F.concat(F.lit("M"), month))
        .when(priority == "2-HIGH", F.concat(F.lit("Q0"), F.quarter(day)))
        .when(priority == "3-MEDIUM", "A01")
        .when(priority == "4-NOT SPECIFIED", F.when(F.month(day) < 7, "S01").otherwise("S02"))
        .otherwise(F.concat(F.lit("m"), month))
    )
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(day, "yyyy").alias("year"), code.alias("code"), *extra)


@query(f"SELECT o_orderkey, CAST({_CODES} AS DATE) AS observation_date FROM orders")
def parse_period_coded(spark, sf):
    return _coded(spark, sf).select("o_orderkey", S.parse_period_coded("year", "code").alias("observation_date"))


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'monthly' WHEN '2-HIGH' THEN 'quarterly'
  WHEN '3-MEDIUM' THEN 'annual' WHEN '4-NOT SPECIFIED' THEN 'semi_annual' ELSE 'monthly' END AS frequency
FROM orders""")
def infer_frequency(spark, sf):
    return _coded(spark, sf).select("o_orderkey", S.infer_frequency("code").alias("frequency"))


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN NULL
  WHEN 'signup' THEN CASE WHEN value > 100 THEN CAST('inf' AS DOUBLE) ELSE NULL END ELSE value END AS number
FROM events""")
def safe_double(spark, sf):
    kind, value = F.col("event_type"), F.col("value").cast("string")
    text = (
        F.when(kind == "error", F.concat(value, F.lit("d")))
        .when(kind == "click", F.concat(F.lit("1_"), value))
        .when(kind == "signup", F.when(F.col("value") > 100, "inf").otherwise("nan"))
        .when(kind == "view", F.concat(F.lit(" "), value, F.lit("e0 ")))
        .otherwise(value)
    )
    return table(spark, sf, "events").select("event_id", S.safe_double(text).alias("number"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS value
FROM lineitem""")
def parse_thousands(spark, sf):
    text = F.when(F.col("l_returnflag") == "R", "(D)").otherwise(F.format_number("l_extendedprice", 2))
    value = S.parse_thousands(S.missing_to_null(text, S.BEA_MISSING))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", value.alias("value"))


@query("""
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS fred,
  CASE WHEN o_orderpriority <= '4-NOT SPECIFIED' THEN NULL ELSE o_totalprice END AS bea,
  CASE WHEN o_orderpriority <= '3-MEDIUM' THEN NULL ELSE o_totalprice END AS bls
FROM orders""")
def missing_tokens(spark, sf):
    price, priority = F.col("o_totalprice").cast("string"), F.col("o_orderpriority")

    def marked(tokens):
        text = F.when(F.lit(False), "")
        for token, name in zip(tokens, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]):
            text = text.when(priority == name, token)
        return S.safe_double(S.missing_to_null(text.otherwise(price), tokens))

    fred = S.missing_to_null(F.when(F.col("o_orderstatus") == "P", ".").otherwise(price), S.FRED_MISSING)
    return table(spark, sf, "orders").select(
        "o_orderkey", S.safe_double(fred).alias("fred"), marked(S.BEA_MISSING).alias("bea"), marked(S.BLS_MISSING).alias("bls")
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
  ELSE CAST(o_orderdate AS DATE) END AS day
FROM orders""")
def normalize_date(spark, sf):
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(priority == "3-MEDIUM", F.date_format(day, "MM/dd/yyyy"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(day, "yyyy-MM"))
        .otherwise(F.date_format(day, "yyyy-'13'-dd"))
    )
    return table(spark, sf, "orders").select("o_orderkey", S.normalize_date(text).alias("day"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_linenumber = 6 THEN date_trunc('month', l_shipdate) "
       "WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS DATE) AS day FROM lineitem")
def normalize_any_date(spark, sf):
    """Dates in seven spellings, one of them with a month that does not exist."""
    formats = ["MMMM d, yyyy", "dd-MMM-yyyy", "yyyy/M/d", "M/d/yyyy h:mm a", "d MMM yyyy", "MMM yyyy", "d 'Xyz' yyyy"]
    text = F.element_at(F.array(*[F.date_format("l_shipdate", f) for f in formats]), F.col("l_linenumber"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, sf, "lineitem").select(*keys, S.normalize_date(text).alias("day"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month,
       CAST(date_trunc('quarter', l_shipdate) AS DATE) AS ship_quarter,
       CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS month_of_year
FROM lineitem""")
def period_columns(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        S.period_start("l_shipdate", "month").alias("ship_month"),
        S.period_start("l_shipdate", "quarter").alias("ship_quarter"),
        F.year("l_shipdate").alias("ship_year"),
        F.month("l_shipdate").alias("month_of_year"),
    )


@query("SELECT c_custkey, 'https://fred.stlouisfed.org/series/' || c_name AS series_url FROM customer")
def series_url(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.series_url("c_name", FRED_SERIES_URL).alias("series_url"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linestatus = 'F' THEN l_returnflag || ',' || l_linestatus
       WHEN l_returnflag = 'A' THEN NULL ELSE l_returnflag END AS footnote_codes
FROM lineitem""")
def footnote_join(spark, sf):
    def note(code):
        return F.struct(code.alias("code"))

    flag, final = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    notes = (
        F.when(final, F.array(note(flag), note(F.lit(None).cast("string")), note(F.col("l_linestatus"))))
        .when(flag == "A", F.array(note(F.lit(""))))
        .otherwise(F.array(note(F.lit("")), note(flag)))
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.join_codes(notes).alias("footnote_codes")
    )


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year FROM orders")
def numeric_year(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-")).otherwise(F.date_format("o_orderdate", "yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", S.numeric_year(text).alias("year"))


@query(f"WITH {FRED} SELECT record_id, coalesce(value_is_missing, value IS NULL) AS is_missing FROM fred")
def missing_flag(spark, sf):
    return fred_bronze(spark, sf).select("record_id", S.missing_flag("value_is_missing", "value").alias("is_missing"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN false ELSE value < 50 END AS inverted FROM events""")
def inverted_flag(spark, sf):
    spread = F.when(F.col("event_type") != "view", F.col("value") - 50)
    return table(spark, sf, "events").select("event_id", S.negative_flag(spread).alias("inverted"))


@query(f"SELECT year(o_orderdate) AS year, count(*) AS n, count({_CODES}) AS dated, "
       "CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS total "
       "FROM orders GROUP BY 1")
def adhoc_sql(spark, sf):
    """SQL text over a registered view, with the parsers as SQL functions."""
    register_functions(spark)
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    register_view(_coded(spark, sf, text.alias("price")), "coded_orders")
    return spark.sql("""
        SELECT CAST(year AS BIGINT) AS year, count(*) AS n, count(code_date(year, code)) AS dated,
               CAST(sum(CAST(coalesce(safe_double(price), 0) AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM coded_orders GROUP BY year""")

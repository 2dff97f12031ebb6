"""Queries of the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrospark.catalog.base import FRED_STAGED, fred_bronze, query, table
from macrospark.operators import quality
from macrospark.plans import staging


def _row(check: str, target: str, observed: str, threshold: float, status: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{target}' AS target, CAST({observed} AS DOUBLE) AS observed, "
            f"CAST({threshold} AS DOUBLE) AS threshold, {status} AS status")


def _zero(n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 'pass' ELSE 'fail' END"


@query(f"WITH {FRED_STAGED}, n AS (SELECT count(*) - count(series_id) AS a, count(*) - count(observation_date) AS b, "
       "count(*) - count(value) AS c FROM staged) "
       + " UNION ALL ".join(
           _row("not_null", t, x, 0, _zero(x)) + " FROM n"
           for t, x in [("series_id", "a"), ("observation_date", "b"), ("value", "c")]))
def check_not_null(spark, sf):
    staged = staging.stage_fred(fred_bronze(spark, sf), ["record_id"])
    return quality.check_not_null(staged, ["series_id", "observation_date", "value"])


@query("WITH n AS (SELECT count(*) AS a FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), "
       "m AS (SELECT count(*) AS a FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) "
       + _row("unique", "l_orderkey,l_linenumber", "a", 0, _zero("a")) + " FROM n UNION ALL "
       + _row("unique", "o_orderkey", "a", 0, _zero("a")) + " FROM m")
def check_unique(spark, sf):
    lines = quality.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return lines.unionByName(quality.check_unique(table(spark, sf, "orders"), ["o_orderkey"]))


@query("WITH n AS (SELECT count(*) FILTER (WHERE quality NOT IN (0, 1)) AS a, count(*) FILTER (WHERE toxic NOT IN (0)) AS b FROM labels) "
       + _row("accepted_values", "quality", "a", 0, _zero("a")) + " FROM n UNION ALL "
       + _row("accepted_values", "toxic", "b", 0, _zero("b")) + " FROM n")
def check_accepted_values(spark, sf):
    labels = table(spark, sf, "labels")
    return quality.check_accepted_values(labels, "quality", [0, 1]).unionByName(
        quality.check_accepted_values(labels, "toxic", [0])
    )


@query("""
SELECT 'freshness' AS "check", 'ts' AS target, round(age, 6) AS observed, CAST(3 AS DOUBLE) AS threshold, CASE WHEN age > 3 THEN 'error' WHEN age > 1 THEN 'warn' ELSE 'ok' END AS status
FROM (SELECT (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 86400e6 AS age FROM events)
UNION ALL
SELECT 'freshness', 'o_orderdate', round(age, 6), 3, CASE WHEN age > 3 THEN 'error' WHEN age > 1 THEN 'warn' ELSE 'ok' END
FROM (SELECT (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(o_orderdate))) / 86400e6 AS age FROM orders)""")
def check_freshness(spark, sf):
    as_of = F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")
    report = quality.check_freshness(table(spark, sf, "events"), "ts", as_of).unionByName(
        quality.check_freshness(table(spark, sf, "orders"), "o_orderdate", as_of)
    )
    return report.withColumn("observed", F.round("observed", 6))


@query("WITH n AS (SELECT count(DISTINCT event_type) FILTER (WHERE ts >= TIMESTAMP '2024-01-30 21:00:00') AS a FROM events) "
       + _row("refreshed_keys", "event_type", "a", 5, "CASE WHEN a >= 5 THEN 'pass' ELSE 'fail' END") + " FROM n")
def check_refreshed(spark, sf):
    as_of = F.lit("2024-01-30 23:00:00").cast("timestamp_ntz")
    return quality.check_refreshed(table(spark, sf, "events"), "event_type", "ts", as_of)


@query("WITH n AS (SELECT greatest(date_diff('day', DATE '2001-06-30', CAST(max(l_shipdate) AS DATE)), 0) AS a, "
       "greatest(date_diff('day', DATE '2024-01-31', CAST(max(l_shipdate) AS DATE)), 0) AS b FROM lineitem) "
       + _row("no_future_dates", "l_shipdate", "a", 0, _zero("a")) + " FROM n UNION ALL "
       + _row("no_future_dates", "l_shipdate", "b", 0, _zero("b")) + " FROM n")
def no_future_dates(spark, sf):
    lines = table(spark, sf, "lineitem")
    days = ("2001-06-30", "2024-01-31")
    early, late = (quality.check_no_future(lines, "l_shipdate", F.lit(d).cast("date")) for d in days)
    return early.unionByName(late)


@query(f"WITH {FRED_STAGED}, n AS (SELECT count(value) / count(*) AS r, count(*) AS total, "
       "(SELECT count(*) FROM (VALUES ('FEDFUNDS'), ('M2SL'), ('NOWHERE')) AS w(s) WHERE s NOT IN (SELECT series_id FROM staged)) AS absent FROM staged) "
       + " UNION ALL ".join([
           _row("non_empty", "staged", "CASE WHEN total > 0 THEN 1 ELSE 0 END", 1, "CASE WHEN total > 0 THEN 'pass' ELSE 'fail' END") + " FROM n",
           _row("required_column", "series_id", "1", 1, "'pass'"),
           _row("required_column", "vintage", "0", 1, "'fail'"),
           _row("non_null_ratio", "value", "r", 0.8, "CASE WHEN r > 0.8 THEN 'pass' ELSE 'fail' END") + " FROM n",
           _row("required_members", "series_id", "absent", 0, _zero("absent")) + " FROM n"]))
def input_checks(spark, sf):
    """The checks run on a frame before it is merged."""
    staged = staging.stage_fred(fred_bronze(spark, sf), ["record_id"])
    report = quality.check_non_empty(staged, "staged")
    for check in (
        quality.check_columns(staged, ["series_id", "vintage"]),
        quality.check_non_null_ratio(staged, "value"),
        quality.check_members(staged, "series_id", ["FEDFUNDS", "M2SL", "NOWHERE"]),
    ):
        report = report.unionByName(check)
    return report

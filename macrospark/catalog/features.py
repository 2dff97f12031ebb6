"""Queries of the calendar, pivot, join, aggregate and window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrospark.catalog.base import (
    ENTITY, MONTH_SPINE, MONTHLY, MONTHLY_WIDE, SERIES_COLUMNS,
    obs_entity, obs_monthly, query, table,
)
from macrospark.functions import scalars as S
from macrospark.operators import calendar, features, joins, pivot, rollup, select

_DENSE = MONTHLY_WIDE + "," + MONTH_SPINE + """,
dense AS (SELECT s.month, w.* EXCLUDE (month) FROM spine s LEFT JOIN wide w ON w.month = s.month)"""

_COLUMNS = list(SERIES_COLUMNS.values())


def _wide(spark, sf):
    return pivot.pivot_wide(obs_monthly(spark, sf), ["month"], "series_id", "value", SERIES_COLUMNS, ["month"])


def _months(spark, sf):
    return calendar.spine_of(table(spark, sf, "orders"), "o_orderdate", "month")


def _dense(spark, sf):
    return _months(spark, sf).join(_wide(spark, sf), "month", "left")


@query(f"WITH {MONTH_SPINE} SELECT month FROM spine")
def month_spine(spark, sf):
    return _months(spark, sf)


@query(f"""
WITH {ENTITY}, bounds AS (SELECT c_nationkey, min(month) AS lo, max(month) AS hi FROM entity GROUP BY 1),
grid AS (SELECT c_nationkey, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
         FROM bounds)
SELECT g.c_nationkey, g.month, e.value FROM grid g LEFT JOIN entity e ON e.c_nationkey = g.c_nationkey AND e.month = g.month""")
def dense_grid(spark, sf):
    observed = obs_entity(spark, sf)
    return calendar.dense_grid(observed, ["c_nationkey"], "month").join(observed, ["c_nationkey", "month"], "left")


@query(f"WITH {MONTHLY_WIDE} SELECT * FROM wide")
def pivot_wide(spark, sf):
    return _wide(spark, sf)


@query(f"WITH {_DENSE} SELECT month, {', '.join(_COLUMNS)} FROM dense")
def spine_left_join(spark, sf):
    return _dense(spark, sf)


@query(f"""
WITH {_DENSE} SELECT month AS period, CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month,
  CAST(date_trunc('quarter', month) AS DATE) AS quarter, {', '.join(_COLUMNS)} FROM dense""")
def wide_mart(spark, sf):
    wide = _wide(spark, sf).withColumnRenamed("month", "period")
    months = calendar.spine_of(table(spark, sf, "orders"), "o_orderdate", "period")
    return calendar.on_spine(months, wide, "period")


@query(f"""
WITH {MONTH_SPINE}, quarterly AS (
  SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS gdp
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT s.month, q.gdp FROM spine s LEFT JOIN quarterly q ON q.month = s.month""")
def quarter_alignment(spark, sf):
    final = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    total = F.sum(S.decimal_double("o_totalprice")).cast("double")
    quarterly = final.groupBy(S.period_start("o_orderdate", "quarter").alias("month")).agg(total.alias("gdp"))
    return _months(spark, sf).join(quarterly, "month", "left")


_LINE_MONTHS = """
shipped AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
                   CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS shipped FROM lineitem GROUP BY 1),
ordered AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ordered FROM orders GROUP BY 1)"""


def _monthly_sum(df, date, value, name):
    total = F.sum(S.decimal_double(value)).cast("double")
    return df.groupBy(S.period_start(date, "month").alias("month")).agg(total.alias(name))


@query(f"WITH {_LINE_MONTHS} SELECT coalesce(o.month, s.month) AS month, ordered, shipped "
       "FROM ordered o FULL JOIN shipped s ON o.month = s.month")
def outer_merge(spark, sf):
    ordered = _monthly_sum(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", "ordered")
    shipped = _monthly_sum(table(spark, sf, "lineitem"), "l_shipdate", "l_extendedprice", "shipped")
    return joins.outer_merge(ordered, shipped, ["month"])


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS asked_at, l_extendedprice AS known_price, CAST(l_shipdate AS DATE) AS known_since
FROM orders LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate DESC,
    l_linenumber DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem JOIN (SELECT o_orderkey, o_orderdate AS cutoff FROM orders) ON l_orderkey = o_orderkey AND l_shipdate <= cutoff) k
USING (o_orderkey) WHERE coalesce(rn, 1) = 1""")
def point_in_time_join(spark, sf):
    """For every order the line price that was known at its date."""
    asks = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("asked_at"))
    ties = ["l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"]
    vintages = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", F.col("l_extendedprice").alias("known_price"),
        F.col("l_shipdate").cast("date").alias("known_since"), *ties,
    )
    known = joins.asof_join(asks, vintages, ["o_orderkey"], "asked_at", "l_shipdate", ["known_price", "known_since"], ties)
    return known.withColumn("asked_at", F.col("asked_at").cast("date"))


@query("""
SELECT e.event_id, arg_max(known.event_id, (known.ts, known.event_id)) AS last_event
FROM events e LEFT JOIN events known ON known.event_type = e.event_type AND known.ts <= e.ts AND known.value >= 50
GROUP BY e.event_id""")
def point_in_time_hot(spark, sf):
    """For every event the last one of its type (there are five types) with a large value."""
    events = table(spark, sf, "events")
    large = events.filter("value >= 50").select("event_type", F.col("ts").alias("at"), F.col("event_id").alias("last_event"))
    asks = events.select("event_type", "ts", "event_id")
    return joins.asof_join(asks, large, ["event_type"], "ts", "at", ["last_event"], ["last_event"]).select("event_id", "last_event")


_SERIES_META = """
dim(series_id, rank) AS (VALUES ('1-URGENT', 'first'), ('2-HIGH', 'second'), ('3-MEDIUM', 'third'))"""


@query(f"WITH {_SERIES_META} SELECT o_orderkey, o_orderpriority AS series_id, coalesce(rank, 'unknown') AS rank "
       "FROM orders LEFT JOIN dim ON series_id = o_orderpriority")
def dim_lookup(spark, sf):
    from macrospark.sources.inline import inline_table

    dim = inline_table(spark, [("1-URGENT", "first"), ("2-HIGH", "second"), ("3-MEDIUM", "third")], "series_id string, rank string")
    keyed = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("series_id"))
    return joins.lookup(keyed, dim, ["series_id"], {"rank": "unknown"})


@query(f"""
WITH {MONTHLY}, known AS (
  SELECT CAST(date_trunc('quarter', month) AS DATE) AS quarter, series_id, value,
         row_number() OVER (PARTITION BY date_trunc('quarter', month), series_id ORDER BY month DESC) AS rn
  FROM monthly WHERE value IS NOT NULL)
SELECT quarter, {', '.join(f"max(value) FILTER (WHERE series_id = '{p}') AS {c}" for p, c in SERIES_COLUMNS.items())}
FROM known WHERE rn = 1 GROUP BY quarter""")
def pivot_last_nonnull(spark, sf):
    quarterly = obs_monthly(spark, sf).withColumn("quarter", F.trunc("month", "quarter"))
    return pivot.pivot_last(quarterly, ["quarter"], "series_id", "value", SERIES_COLUMNS, ["month"])


@query("""
SELECT event_type, period, value FROM (
  SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS period, value,
         row_number() OVER (PARTITION BY event_type, date_trunc('month', ts) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def resample_month_last(spark, sf):
    return pivot.resample_last(table(spark, sf, "events"), ["event_type"], "ts", "value", "month", ["ts", "event_id"])


@query("""
SELECT event_type, period, value FROM (
  SELECT event_type, CAST(ts AS DATE) AS period, value,
         row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def resample_day_last(spark, sf):
    return pivot.resample_last(table(spark, sf, "events"), ["event_type"], "ts", "value", "day", ["ts", "event_id"])


@query("""
SELECT year, count(*) AS months, CAST(round(avg(CAST(urgent AS DECIMAL(28,6))), 3) AS DOUBLE) AS avg_urgent,
       CAST(round(avg(CAST(low AS DECIMAL(28,6))), 0) AS DOUBLE) AS avg_low
FROM (WITH """ + MONTHLY_WIDE + """ SELECT CAST(year(month) AS INTEGER) AS year, urgent, low FROM wide) GROUP BY year""")
def yearly_means(spark, sf):
    wide = _wide(spark, sf).withColumn("year", F.year("month"))
    return rollup.annual_rollup(wide, "year", {"avg_urgent": ("urgent", 3), "avg_low": ("low", 0)})


@query("SELECT count(DISTINCT user_id) AS refreshed_keys FROM events WHERE ts >= TIMESTAMP '2024-01-30 22:00:00'")
def freshness_distinct(spark, sf):
    since = F.lit("2024-01-30 22:00:00").cast("timestamp_ntz")
    return rollup.refreshed_keys(table(spark, sf, "events"), "user_id", "ts", since)


@query(f"WITH {MONTHLY} SELECT series_id, count(value) / count(*) AS non_null_ratio FROM monthly GROUP BY 1")
def non_null_ratio(spark, sf):
    return rollup.non_null_ratio(obs_monthly(spark, sf), ["series_id"], "value")


@query("""
SELECT name AS event_type FROM (VALUES ('view'), ('refund'), ('click'), ('chargeback')) AS wanted(name)
WHERE name NOT IN (SELECT event_type FROM events)""")
def required_members(spark, sf):
    return rollup.missing_members(table(spark, sf, "events"), "event_type", ["view", "refund", "click", "chargeback"])


@query("SELECT l_suppkey, l_linenumber, count(*) AS observations FROM lineitem GROUP BY 1, 2")
def series_counts(spark, sf):
    return rollup.series_counts(table(spark, sf, "lineitem"), ["l_suppkey", "l_linenumber"])


@query(f"""
WITH {_DENSE} SELECT month, {', '.join(f"{c} - lag({c}, 1) OVER (ORDER BY month) AS {c}_change" for c in _COLUMNS)} FROM dense""")
def mom_change(spark, sf):
    changes = [features.diff(c, 1, [], "month").alias(f"{c}_change") for c in _COLUMNS]
    return _dense(spark, sf).select("month", *changes)


@query(f"""
WITH {_DENSE} SELECT month, {', '.join(f"{c} - lag({c}, 3) OVER (ORDER BY month) AS {c}_change" for c in _COLUMNS)} FROM dense""")
def three_period_change(spark, sf):
    changes = [features.diff(c, 3, [], "month").alias(f"{c}_change") for c in _COLUMNS]
    return _dense(spark, sf).select("month", *changes)


def _sql_yoy(c: str, over: str, n: int = 12) -> str:
    base = f"lag({c}, {n}) OVER ({over})"
    return f"CAST(round(CAST(100.0 * ({c} - {base}) / nullif({base}, 0) AS DECIMAL(28,6)), 2) AS DOUBLE)"


@query(f"WITH {_DENSE} SELECT month, {', '.join(_sql_yoy(c, 'ORDER BY month') + f' AS {c}_yoy' for c in _COLUMNS)} FROM dense")
def yoy_pct(spark, sf):
    rates = [features.yoy_pct(c, [], "month").cast("double").alias(f"{c}_yoy") for c in _COLUMNS]
    return _dense(spark, sf).select("month", *rates)


@query(f"""
WITH {ENTITY}, bounds AS (SELECT c_nationkey, min(month) AS lo, max(month) AS hi FROM entity GROUP BY 1),
grid AS (SELECT c_nationkey, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
         FROM bounds),
dense AS (SELECT g.c_nationkey, g.month, e.value FROM grid g LEFT JOIN entity e ON e.c_nationkey = g.c_nationkey AND e.month = g.month)
SELECT c_nationkey, month, value, value - lag(value, 1) OVER (PARTITION BY c_nationkey ORDER BY month) AS mom,
       {_sql_yoy('value', 'PARTITION BY c_nationkey ORDER BY month')} AS yoy FROM dense""")
def entity_features(spark, sf):
    """Changes of every entity's own series in one plan."""
    dense = calendar.densify(obs_entity(spark, sf), ["c_nationkey"], "month")
    return dense.select(
        "c_nationkey", "month", "value",
        features.diff("value", 1, ["c_nationkey"], "month").alias("mom"),
        features.yoy_pct("value", ["c_nationkey"], "month").cast("double").alias("yoy"),
    )


@query(f"""
WITH {_DENSE}, held AS (
  SELECT month, low, last_value(low IGNORE NULLS) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING) AS h FROM dense)
SELECT month, low, (h / lag(h, 12) OVER (ORDER BY month) - 1) * 100.0 AS low_change FROM held""")
def pct_change_padded(spark, sf):
    dense = _dense(spark, sf).select("month", "low")
    return features.with_pct_change(dense, "low", "low_change", 12, [], "month", factor=100.0)


@query(f"""
WITH {_DENSE} SELECT month, urgent IS NOT NULL AND unspecified IS NOT NULL AND low IS NOT NULL AS is_complete FROM dense""")
def completeness_flag(spark, sf):
    return _dense(spark, sf).select("month", S.complete_flag(["urgent", "unspecified", "low"]).alias("is_complete"))


@query("SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def top_k_recent(spark, sf):
    newest = select.top_recent(table(spark, sf, "events"), ["ts", "event_id"], 10)
    return newest.select("event_id", "event_type", "value")


@query("SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'")
def lookback_filter(spark, sf):
    import datetime

    recent = select.lookback(table(spark, sf, "events"), "ts", 7, datetime.date(2024, 1, 31))
    return recent.select("event_id", "event_type", "value")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'")
def period_window(spark, sf):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1997-12-31"))
    return select.between_periods(table(spark, sf, "orders"), "o_orderdate", start, end).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def series_subset(spark, sf):
    return select.select_series(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"]).select("o_orderkey", "o_orderpriority")


@query("""
SELECT 'orders' AS origin, o_orderkey AS record_id, o_totalprice AS value, NULL AS kind FROM orders
UNION ALL SELECT 'events', event_id, value, event_type FROM events""")
def union_sources(spark, sf):
    orders = table(spark, sf, "orders").select(F.lit("orders").alias("origin"), F.col("o_orderkey").alias("record_id"), F.col("o_totalprice").alias("value"))
    events = table(spark, sf, "events").select(F.lit("events").alias("origin"), F.col("event_id").alias("record_id"), "value", F.col("event_type").alias("kind"))
    return select.stack([orders, events])

"""Queries that write the tables and read them back."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from macrospark.catalog.base import BEA, bea_raw, query, table
from macrospark.operators.select import stack
from macrospark.plans import normalize, refresh, staging
from macrospark.session import new_run_dir
from macrospark.sources import dims, sinks, tables


@query("SELECT o_orderstatus, o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O')")
def parquet_partitioned_scan(spark, sf):
    """A folder per status; the filter reads two of them."""
    path = new_run_dir(spark, "by-status")
    sinks.overwrite_table(table(spark, sf, "orders"), path, ["o_orderstatus"])
    scan = tables.read_table(spark, path).filter(F.col("o_orderstatus").isin("F", "O"))
    return scan.select("o_orderstatus", "o_orderkey", "o_totalprice", "o_orderpriority")


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def nested_folder_scan(spark, sf):
    """Files in folders of plain names, at several depths below one path."""
    path, orders = new_run_dir(spark, "nested"), table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for status, folder in {"F": "closed", "O": "open/current", "P": "open/late/partly"}.items():
        sinks.write_parquet(orders.filter(F.col("o_orderstatus") == status), f"{path}/{folder}")
    return tables.read_table(spark, path)


@query("SELECT count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, event_type FROM events GROUP BY event_type")
def register_views(spark, sf):
    """Views by name; the one without a table is skipped."""
    names = tables.register_tables(spark, {"catalog_events": f"{sf}/events.parquet", "catalog_prices": f"{sf}/absent.parquet"})
    if names != ["catalog_events"]:
        raise ValueError(f"unexpected views: {names}")
    return spark.sql(
        "SELECT count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, event_type FROM catalog_events GROUP BY event_type"
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_shipdate AS DATE) AS shipped FROM lineitem")
def parquet_roundtrip(spark, sf):
    path = new_run_dir(spark, "lines-parquet")
    lines = table(spark, sf, "lineitem")
    rows = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_shipdate").cast("date").alias("shipped"))
    sinks.write_parquet(rows, path)
    return tables.read_table(spark, path)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_roundtrip(spark, sf):
    path = new_run_dir(spark, "orders-csv")
    rows = table(spark, sf, "orders").drop("o_orderdate")
    sinks.export_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query("""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def schema_evolution(spark, sf):
    """Early files lack a column that later ones have."""
    path = new_run_dir(spark, "evolving")
    orders = table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    sinks.load_raw(orders.filter(~late).select("o_orderkey", "o_totalprice"), path)
    sinks.load_raw(orders.filter(late).select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    return tables.read_table(spark, path, mergeSchema=True)


@query("""
SELECT 'whole' AS part, o_orderkey, o_totalprice FROM orders
UNION ALL SELECT 'second', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def daily_replace(spark, sf):
    """A day's archive is replaced when it is written again; other days stay."""
    root = new_run_dir(spark, "processed")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    first, second = datetime.date(2024, 1, 30), datetime.date(2024, 1, 31)
    sinks.archive_parquet(orders.drop("o_orderstatus"), root, "shop", "orders", first)
    sinks.archive_parquet(orders.drop("o_orderstatus"), root, "shop", "orders", second)
    path = sinks.archive_parquet(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), root, "shop", "orders", second)
    days = tables.read_table(spark, path)
    part = F.when(F.col("day") == 30, "whole").otherwise("second")
    return days.select(part.alias("part"), "o_orderkey", "o_totalprice")


@query("""
WITH monthly AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2)
SELECT 'parquet' AS sink, * FROM monthly UNION ALL SELECT 'csv', * FROM monthly UNION ALL SELECT 'table', * FROM monthly""")
def sink_fan_out(spark, sf):
    """One result computed once and given to three sinks."""
    root = new_run_dir(spark, "fan-out")
    orders = table(spark, sf, "orders")
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    monthly = orders.groupBy("o_orderpriority", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(total.alias("total"))
    sinks.fan_out(
        monthly,
        [
            lambda df: sinks.write_parquet(df, f"{root}/parquet"),
            lambda df: sinks.export_csv(df, f"{root}/csv"),
            lambda df: sinks.materialize(df, "monthly_totals", "table", f"{root}/table"),
        ],
    )
    read = {
        "parquet": spark.read.parquet(f"{root}/parquet"),
        "csv": spark.read.schema(monthly.schema).option("header", True).csv(f"{root}/csv"),
        "table": spark.table("monthly_totals"),
    }
    return stack([df.withColumn("sink", F.lit(name)) for name, df in read.items()])


@query(f"""
WITH {BEA} SELECT table_key, series_name, period_date, value, value IS NULL AS is_missing, frequency
FROM (SELECT *, row_number() OVER (PARTITION BY table_key, series_name, period_date
        ORDER BY ingested_at DESC, value DESC NULLS LAST) AS rn FROM bea WHERE period_date IS NOT NULL) WHERE rn = 1""")
def source_refresh(spark, sf):
    """Raw records through bronze, the versioned table and staging."""
    at = F.col("ingested_at")
    bronze, _ = normalize.normalize_bea(bea_raw(spark, sf), dims.bea_line_dim(spark), at)
    staged, _ = refresh.refresh_source(
        spark, bronze, refresh.TABLES["bea_nipa_observations"], new_run_dir(spark, "refresh"),
        staging.stage_bea, datetime.datetime(2024, 1, 31, tzinfo=datetime.timezone.utc),
    )
    return staged.select("table_key", "series_name", "period_date", "value", "is_missing", "frequency")

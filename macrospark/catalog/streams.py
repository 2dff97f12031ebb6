"""Streaming queries. Each runs over what is in the folder and gives the written result."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrospark.catalog.base import query, table
from macrospark.operators import sketches
from macrospark.session import new_run_dir
from macrospark.sources.versioned import VersionedTable
from macrospark.streaming import streams


def _events(spark, sf):
    # a glob, since a file stream reads folders
    return streams.stream_parquet(spark, f"{sf}/events*.parquet", table(spark, sf, "events").schema)


# Rows of a landed file at most; with a fixed number of files a micro-batch, the batches grow with the rows alone.
_LANDED_ROWS = 2_000_000

_ROWS = "SELECT event_id, event_type, user_id, value FROM events"


@query(_ROWS)
def stream_dedupe(spark, sf):
    """Every event arrives twice and is kept once."""
    root = new_run_dir(spark, "stream-dedupe")
    doubled = _events(spark, sf).unionByName(_events(spark, sf))
    once = streams.drop_replays(doubled, ["event_id"], "ts", "1 day", salts=8)
    streams.write_stream(once.select("event_id", "event_type", "user_id", "value"), f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def stream_upsert(spark, sf):
    """Each customer's newest order, from several micro-batches of which the last holds the oldest orders.

    The stream remembers each customer's newest order, so a batch writes only the customers it changes.
    """
    root = new_run_dir(spark, "stream-upsert")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    year_of = F.year("o_orderdate")
    vintage = F.when(year_of <= 1992, 1992).when(year_of >= 1998, 1998).otherwise(year_of)
    rows = {r["year"]: r["count"] for r in orders.groupBy(vintage.alias("year")).count().collect()}  # seven, and nulls
    for year in range(1998, 1991, -1):  # written newest first, so that old vintages arrive late
        files = -(-rows.get(year, 1) // _LANDED_ROWS)
        orders.filter(vintage == year).repartition(files).write.mode("append").parquet(f"{root}/landed")
    stored = VersionedTable(spark, f"{root}/table", ["o_custkey"], order=["o_orderdate", "o_orderkey"])
    arriving = streams.stream_parquet(spark, f"{root}/landed", orders.schema, max_files=2)
    streams.upsert_stream(arriving, stored, f"{root}/checkpoint", remember=True).awaitTermination()
    return stored.read()


@query("""
SELECT strftime(time_bucket(INTERVAL 2 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS rows,
       count(DISTINCT event_type) AS refreshed_keys FROM events GROUP BY 1""")
def stream_freshness(spark, sf):
    """Distinct event types per two hours; with so few of them the sketch is exact."""
    root = new_run_dir(spark, "stream-freshness")
    counts = streams.refreshed_by_window(_events(spark, sf), "event_type", "ts")
    streams.write_complete(counts, f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    written = spark.read.parquet(f"{root}/counts")
    start = F.to_utc_timestamp("window.start", F.current_timezone())
    return written.select(F.date_format(start, "yyyy-MM-dd HH:mm").alias("window_start"), "rows", "refreshed_keys")


@query("""
SELECT CAST(ts AS DATE) AS day, count(*) AS rows, true AS users_within_error, count(DISTINCT event_type) AS types
FROM events GROUP BY 1""")
def stream_sketch_rollup(spark, sf):
    """Distinct users per two hours as stored sketches, merged to days; they must lie within five standard errors."""
    root = new_run_dir(spark, "stream-sketches")
    for key in ("user_id", "event_type"):
        windows = streams.sketched_by_window(_events(spark, sf), key, "ts")
        streams.write_complete(windows, f"{root}/{key}", f"{root}/checkpoint-{key}").awaitTermination()

    def days(key: str):
        stored = spark.read.parquet(f"{root}/{key}")
        start = F.to_utc_timestamp("window.start", F.current_timezone())
        return sketches.distinct_keys(sketches.rolled_up(stored, [start.cast("date").alias("day")]), key)

    exact = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count_distinct("user_id").alias("exact"))
    near = F.abs(F.col("user_id") - F.col("exact")) <= F.col("exact") * (5 * sketches.STANDARD_ERROR)
    joined = days("user_id").join(exact, "day").join(days("event_type").select("day", F.col("event_type").alias("types")), "day")
    return joined.select("day", "rows", near.alias("users_within_error"), "types")

"""Queries of upsert, time travel, history and retention."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from macrospark.catalog.base import LINE_KEY, LINE_TIES, LOG, SQL_NEWEST, change_log, query, sql_state, table
from macrospark.operators import changelog, dedupe
from macrospark.session import new_run_dir
from macrospark.sources.versioned import VersionedTable

_LATEST = f"""
old AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_NEWEST}) AS rn
  FROM lineitem WHERE l_returnflag <> 'R') WHERE rn = 1),
new AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_NEWEST}) AS rn
  FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1)"""
_VALUES = ["l_extendedprice", "l_quantity"]


def _two_loads(spark, sf):
    """A table of the lines kept, and a load of the lines returned; some keys are in both."""
    lines = table(spark, sf, "lineitem")
    order = ["l_shipdate", *LINE_TIES]
    kept, returned = lines.filter("l_returnflag <> 'R'"), lines.filter("l_returnflag = 'R'")
    return dedupe.latest_values(kept, LINE_KEY, _VALUES, order), dedupe.latest_values(returned, LINE_KEY, _VALUES, order)


@query(f"""
WITH {_LATEST} SELECT * FROM new UNION ALL
SELECT * FROM old WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM new)""")
def upsert_merge(spark, sf):
    target, source = _two_loads(spark, sf)
    return changelog.upsert(target, source, LINE_KEY)


def _stored(spark, sf, buckets: int | None = None) -> VersionedTable:
    """The same two loads committed to a versioned table of this run."""
    target, source = _two_loads(spark, sf)
    stored = VersionedTable(spark, new_run_dir(spark, "lines"), LINE_KEY, buckets=buckets)
    stored.upsert(target, datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc))
    stored.upsert(source, datetime.datetime(2024, 1, 8, tzinfo=datetime.timezone.utc))
    return stored


@query(f"""
WITH {_LATEST}, state AS (SELECT * FROM new UNION ALL
  SELECT * FROM old WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM new))
SELECT 'first' AS state, * FROM old UNION ALL SELECT 'second', * FROM state""")
def stored_versions(spark, sf):
    """Both states of a stored table, the second read after compaction."""
    stored = _stored(spark, sf)
    stored.compact(at=datetime.datetime(2024, 1, 9, tzinfo=datetime.timezone.utc))
    first = stored.read(version=0).withColumn("state", F.lit("first"))
    return first.unionByName(stored.read().withColumn("state", F.lit("second")))


@query(f"""
WITH {_LATEST}, both_keys AS (SELECT count(*) AS n FROM old JOIN new USING (l_orderkey, l_linenumber))
SELECT 0 AS version, 'merge' AS kind, (SELECT count(*) FROM old) AS inserted, 0 AS updated, (SELECT count(*) FROM old) AS total
UNION ALL SELECT 1, 'merge', (SELECT count(*) FROM new) - n, n, (SELECT count(*) FROM new) FROM both_keys""")
def stored_history(spark, sf):
    return _stored(spark, sf).history().drop("committed_at")


@query(f"""
WITH {_LATEST}, both_keys AS (SELECT count(*) AS n FROM old JOIN new USING (l_orderkey, l_linenumber))
SELECT 0 AS version, (SELECT count(*) FROM old) AS row_count
UNION ALL SELECT 1, (SELECT count(*) FROM old) + (SELECT count(*) FROM new) - n FROM both_keys""")
def stored_counts(spark, sf):
    return _stored(spark, sf).row_counts([0, 1])


@query(f"""
WITH {_LATEST}, one AS (SELECT max(l_orderkey) AS k FROM old)
SELECT * FROM old UNION ALL SELECT k + 1, 1, 1.0, 1.0 FROM one""")
def stored_overwrite(spark, sf):
    """A table overwritten, then given one unrelated key: nothing else changes."""
    target, _ = _two_loads(spark, sf)
    stored = VersionedTable(spark, new_run_dir(spark, "lines"), LINE_KEY)
    stored.overwrite(target)
    extra = target.agg((F.max("l_orderkey") + 1).alias("l_orderkey")).select(
        "l_orderkey", F.lit(1).cast(target.schema["l_linenumber"].dataType).alias("l_linenumber"),
        F.lit(1.0).alias("l_extendedprice"), F.lit(1.0).alias("l_quantity"))
    stored.upsert(extra)
    return stored.read()


@query(f"""
WITH {_LATEST} SELECT l_orderkey, l_linenumber, CASE WHEN o.l_quantity IS NULL THEN 'added' ELSE 'changed' END AS change
FROM new n LEFT JOIN old o USING (l_orderkey, l_linenumber)
WHERE o.l_quantity IS NULL OR o.l_quantity <> n.l_quantity OR o.l_extendedprice <> n.l_extendedprice""")
def stored_diff(spark, sf):
    """Keys that differ between the two stored versions."""
    return _stored(spark, sf).compare(0, 1)


@query(f"""
WITH {_LATEST} SELECT l_orderkey, l_linenumber, 'changed' AS change FROM new WHERE (l_quantity + 1) % 10 = 0""")
def stored_diff_by_summaries(spark, sf):
    """Keys whose values a whole rewrite changed; only buckets whose summaries differ are read."""
    _, loaded = _two_loads(spark, sf)
    stored = VersionedTable(spark, new_run_dir(spark, "summarised"), LINE_KEY, buckets=8)
    stored.overwrite(loaded)
    stored.compact()
    price = F.when((F.col("l_quantity") + 1) % 10 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    stored.overwrite(loaded.withColumn("l_extendedprice", price))
    same = stored.compare(0, 1).withColumn("change", F.lit("of no row"))  # a compaction changes nothing
    return stored.compare(1, 2).unionByName(same)


@query(f"WITH {_LATEST} SELECT * FROM old")
def stored_as_of_timestamp(spark, sf):
    """The stored table as it was between its two commits."""
    return _stored(spark, sf).read(at=datetime.datetime(2024, 1, 5, tzinfo=datetime.timezone.utc))


@query(f"""
WITH {_LATEST} SELECT * FROM new UNION ALL
SELECT * FROM old WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM new)""")
def stored_retention(spark, sf):
    """The newest state after all versions that it does not need were deleted."""
    stored = _stored(spark, sf)
    stored.compact(at=datetime.datetime(2024, 1, 9, tzinfo=datetime.timezone.utc))
    stored.expire(now=datetime.datetime(2024, 2, 9, tzinfo=datetime.timezone.utc))
    return stored.read()


@query(f"WITH {LOG}, {sql_state('version <= 3', 'state')} SELECT * FROM state")
def as_of_version(spark, sf):
    return changelog.as_of_version(change_log(spark, sf), LINE_KEY, 3)


@query(f"WITH {LOG}, {sql_state('committed_at <= DATE ' + chr(39) + '1997-06-30' + chr(39), 'state')} SELECT * FROM state")
def as_of_timestamp(spark, sf):
    moment = F.lit("1997-06-30 00:00:00").cast("timestamp_ntz")
    return changelog.as_of_timestamp(change_log(spark, sf), LINE_KEY, moment)


@query(f"""
WITH {LOG} SELECT version AS _version, count(*) FILTER (WHERE op = 'insert') AS inserted,
  count(*) FILTER (WHERE op = 'update') AS updated, count(*) AS total FROM log GROUP BY version""")
def change_history(spark, sf):
    return changelog.history(change_log(spark, sf), LINE_KEY)


@query(f"""
WITH {LOG}, {sql_state('version <= 2', 'a')}, {sql_state('version <= 5', 'b')}
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
  CASE WHEN a.l_orderkey IS NULL THEN 'added' WHEN b.l_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
WHERE a.l_orderkey IS NULL OR b.l_orderkey IS NULL OR a.l_quantity <> b.l_quantity OR a.l_extendedprice <> b.l_extendedprice""")
def version_diff(spark, sf):
    return changelog.log_diff(change_log(spark, sf), LINE_KEY, 2, 5)


@query(f"""
WITH {LOG}, {sql_state('version <= 0', 'a')}, {sql_state('true', 'b')}
SELECT 0 AS version, count(*) AS row_count FROM a UNION ALL SELECT 6, count(*) FROM b""")
def version_counts(spark, sf):
    """Rows of the oldest and of the newest version."""
    return changelog.state_counts(change_log(spark, sf), LINE_KEY, [0, 6])


@query(f"""
WITH {LOG}, old AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY version DESC) AS rn
  FROM log WHERE committed_at < DATE '1999-01-01')
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, version AS _version FROM old WHERE rn = 1
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, version FROM log WHERE committed_at >= DATE '1999-01-01'""")
def retention_filter(spark, sf):
    cutoff = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return changelog.retain(change_log(spark, sf), LINE_KEY, cutoff).drop("_committed_at")


@query("""
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice ELSE o_custkey END AS DOUBLE) AS amount,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def type_promotion(spark, sf):
    """A column that is INT, then BIGINT, then DOUBLE in three commits; a narrower fourth is refused."""
    orders = table(spark, sf, "orders")
    stored = VersionedTable(spark, new_run_dir(spark, "promoted"), ["o_orderkey"])
    part = lambda n: orders.filter(F.col("o_orderkey") % 3 == n)
    stored.upsert(part(0).select("o_orderkey", F.col("o_custkey").cast("int").alias("amount")))
    stored.upsert(part(1).select("o_orderkey", F.col("o_custkey").alias("amount")))
    stored.upsert(part(2).select("o_orderkey", F.col("o_totalprice").alias("amount"), "o_orderpriority"))
    try:
        stored.upsert(part(0).select("o_orderkey", F.col("o_custkey").alias("amount")))
    except ValueError:
        return stored.read()
    raise ValueError("a narrower type was let in")


@query(f"""
WITH {_LATEST}, newest AS (
  SELECT * FROM new UNION ALL
  SELECT * FROM old WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM new))
SELECT (SELECT count(*) FROM old) AS rows_then, (SELECT count(*) FROM newest) AS rows_now,
       (SELECT count(*) FROM old) AS rows_on_the_fifth,
       (SELECT count(*) FROM newest n JOIN old o USING (l_orderkey, l_linenumber) WHERE n.l_extendedprice <> o.l_extendedprice) AS repriced""")
def sql_time_travel(spark, sf):
    """Past states of a stored table by SQL text alone."""
    _stored(spark, sf).register("lines")
    return spark.sql("""
        SELECT (SELECT count(*) FROM lines_at(0)) AS rows_then, (SELECT count(*) FROM lines_at(1)) AS rows_now,
               (SELECT count(*) FROM lines_asof(TIMESTAMP '2024-01-05 00:00:00')) AS rows_on_the_fifth,
               (SELECT count(*) FROM lines_at(1) n JOIN lines_at(0) o USING (l_orderkey, l_linenumber)
                WHERE n.l_extendedprice <> o.l_extendedprice) AS repriced""")

"""Compare a Spark result with DuckDB's, value by value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_plain(row[n]) for n in names) for row in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    found = [d[0] for d in cursor.description]
    names = sorted(found)
    places = [found.index(n) for n in names]
    return names, sorted(tuple(_plain(row[i]) for i in places) for row in cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """What differs, or None."""
    names, ours = spark_rows(df)
    theirs_names, theirs = duck_rows(con, sql)
    if names != theirs_names:
        return f"columns {names} against {theirs_names}"
    if ours != theirs:
        a, b = set(ours) - set(theirs), set(theirs) - set(ours)
        return f"{names}: {len(ours)} against {len(theirs)} rows; only here {sorted(a)[:3]}; only there {sorted(b)[:3]}"
    return None

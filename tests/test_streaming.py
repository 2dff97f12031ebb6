import random

import pytest
from pyspark.sql import functions as F

from frames import values
from macrospark.catalog import streams as catalog_streams
from macrospark.sources.versioned import VersionedTable
from macrospark.streaming import streams

DDL = "id bigint, t timestamp, v int"


def load(spark, path, lo, hi, v):
    df = spark.range(lo, hi).select("id", F.timestamp_seconds(F.col("id") * 60 + 1_700_006_400).alias("t"), F.lit(v).alias("v"))
    df.coalesce(1).write.mode("append").parquet(path)


def test_replays_are_dropped_across_batches(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for _ in range(2):
        load(spark, src, 0, 50, 1)
        stream = streams.stream_parquet(spark, src, spark.read.parquet(src).schema, max_files=1)
        once = streams.drop_replays(stream.unionByName(stream), ["id"], "t", "7 days", salts=4)
        streams.write_stream(once.select("id", "v"), out, cp).awaitTermination()
    assert values(spark.read.parquet(out)) == [(i, 1) for i in range(50)]


def test_stream_into_versioned_table(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    table = VersionedTable(spark, str(tmp_path / "t"), ["id"], order=["v"])
    for lo, hi, v in ((0, 10, 1), (5, 15, 2)):
        load(spark, src, lo, hi, v)
        stream = streams.stream_parquet(spark, src, spark.read.parquet(src).schema)
        streams.upsert_stream(stream, table, cp).awaitTermination()
    want = [(i, 1) for i in range(5)] + [(i, 2) for i in range(5, 15)]
    assert values(table.read().select("id", "v")) == want
    assert [(r.version, r.inserted, r.updated) for r in table.history().collect()] == [(1, 5, 5), (0, 10, 0)]


def test_a_late_older_vintage_does_not_win(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    table = VersionedTable(spark, str(tmp_path / "t"), ["id"], order=["v"])
    for v in (5, 3):
        load(spark, src, 0, 4, v)
        streams.upsert_stream(streams.stream_parquet(spark, src, spark.read.parquet(src).schema), table, cp).awaitTermination()
    assert values(table.read().select("id", "v")) == [(i, 5) for i in range(4)]
    table.compact()
    assert values(table.read().select("id", "v")) == [(i, 5) for i in range(4)]


def test_a_stream_that_remembers_writes_only_what_changes(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    table = VersionedTable(spark, str(tmp_path / "t"), ["id"], order=["t"])
    rng, best, written, clash = random.Random(3), {}, [], "id bigint, t int, v int, _newest string"
    for number in range(4):
        rows = [(rng.choice([None, 7, *range(6)]), rng.choice([None, 1, 2, 3 + number % 3]), rng.randrange(3), None) for _ in range(30)]
        rows += rows[:5]  # replays
        changed = set()
        for row in rows:
            rank = (row[1] is not None, row[1] or 0, row[2])
            if row[0] not in best or rank > best[row[0]][0]:
                best[row[0]] = rank, row
                changed.add(row[0])
        written.append(len(changed))
        spark.createDataFrame(rows, clash).coalesce(1).write.mode("append").parquet(src)
        stream = streams.stream_parquet(spark, src, spark.read.parquet(src).schema)
        streams.upsert_stream(stream, table, cp, remember=True).awaitTermination()
    versions = {r["_version"]: r["count"] for r in table.changes().groupBy("_version").count().collect()}
    assert [versions.get(i, 0) for i in range(4)] == written and 0 < sum(written[1:]) < 24
    known = {k: row for k, (_, row) in best.items() if k is not None}
    assert {r["id"]: tuple(r) for r in table.read().filter("id is not null").collect()} == known


def test_an_older_batch_after_a_newer_one_writes_nothing(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    table = VersionedTable(spark, str(tmp_path / "t"), ["id"], order=["v"])
    for v in (5, 3, 5):
        load(spark, src, 0, 4, v)
        stream = streams.stream_parquet(spark, src, spark.read.parquet(src).schema)
        streams.upsert_stream(stream, table, cp, remember=True).awaitTermination()
    assert [r["_version"] for r in table.changes().collect()] == [0] * 4
    assert values(table.read().select("id", "v")) == [(i, 5) for i in range(4)]
    with pytest.raises(ValueError, match="order"):
        streams.newest_changes(spark.range(1), ["id"], [])


def test_windows(spark, tmp_path):
    src = str(tmp_path / "in")
    load(spark, src, 0, 300, 1)
    counts = streams.refreshed_by_window(streams.stream_parquet(spark, src, spark.read.parquet(src).schema), "id", "t")
    streams.write_complete(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window.start").collect()
    assert [r.rows for r in got] == [120, 120, 60]
    assert all(abs(r.refreshed_keys - r.rows) <= 0.1 * r.rows for r in got)


@pytest.mark.parametrize("rows, files", [(1000, 7), (40, 9)])
def test_micro_batches_grow_with_the_rows_not_with_the_input_files(spark, tmp_path, monkeypatch, rows, files):
    orders = [(i, i % 30, float(i), f"{1990 + i % 12}-0{1 + i % 9}-01 00:00:00") for i in range(240)] + [(999, 77, 1.0, None)]
    df = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, day string")
    df = df.withColumn("o_orderdate", F.col("day").cast("timestamp_ntz")).drop("day")
    df.repartition(6).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(catalog_streams, "new_run_dir", lambda *_: str(tmp_path / "run"))
    monkeypatch.setattr(catalog_streams, "_LANDED_ROWS", rows)
    got = catalog_streams.stream_upsert(spark, str(tmp_path)).collect()
    best = {c: max((str(d), k) for k, c2, _, d in orders if c2 == c) for c in range(30)}
    assert {r["o_custkey"]: (str(r["o_orderdate"]), r["o_orderkey"]) for r in got} == best and len(got) == 30
    assert len(list((tmp_path / "run/landed").glob("*.parquet"))) == files
    assert len(list((tmp_path / "run/table/data").iterdir())) == -(-files // 2)

"""Comparison of versions by the summaries of their buckets."""

import pytest
from pyspark.sql import functions as F

from frames import values
from macrospark.sources.versioned import VersionedTable


def _table(spark, path, **options):
    return VersionedTable(spark, str(path), ["k"], **options)


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_differing_buckets_are_read(spark, tmp_path):
    table = _table(spark, tmp_path, buckets=16)
    first = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("w"))
    table.overwrite(first)
    table.overwrite(first.repartition(3).withColumn("v", F.when(F.col("k") == 11, -1).otherwise(F.col("v"))))
    assert len(table._differing(table._records(0), table._records(1))) == 1
    change = table.compare(0, 1)
    assert values(change) == [(11, "changed")]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = _scans(change)
    assert plan.count("PartitionFilters: [isnotnull(_bucket_of_16") + plan.count("PartitionFilters: [(_bucket_of_16") == 2
    # after a compaction and an equal overwrite nothing is read
    table.compact()
    table.overwrite(table.read())
    assert table._differing(table._records(1), table._records(3)) == [] and values(table.compare(1, 3)) == []


def test_equals_the_plain_comparison(spark, rows, tmp_path):
    plain, summed = _table(spark, tmp_path / "a"), _table(spark, tmp_path / "b", buckets=4)
    for table in (plain, summed):
        table.upsert(rows([(1, "a", None), (2, "b", "x"), (None, "n", "n"), (5, None, "m")], "k int, v string, w string"))
        table.upsert(rows([(2, "c", "x"), (3, None, None)], "k int, v string, w string"))
        table.overwrite(rows([(1, None, "a"), (2, "c", "x"), (None, "n", "n"), (5, None, "m")], "k int, v string, w string"))
        table.upsert(rows([(5, "m", None), (6, "s", "t")], "k int, v string, w string"))
        table.compact()
    assert values(plain.read(3)) == values(summed.read(3))
    for old, new in ((0, 1), (0, 3), (1, 2), (2, 3), (2, 4), (3, 4), (4, 1)):
        assert values(plain.compare(old, new)) == values(summed.compare(old, new)), (old, new)
    assert values(summed.history().drop("committed_at")) == values(plain.history().drop("committed_at"))
    assert summed.read().columns == ["k", "v", "w"]
    # a value that moves to the next column, beside nulls, is a change
    assert (1, "changed") in values(summed.compare(1, 2))


def test_wider_keys_are_compared_whole(spark, rows, tmp_path):
    table = _table(spark, tmp_path, buckets=4)
    table.upsert(rows([(1, 1), (2, 2)], "k int, v int"))
    table.upsert(rows([(2, 3), (1 << 40, 4)], "k long, v int"))
    assert table._differing(table._records(0), table._records(1)) is None
    assert values(table.compare(0, 1)) == [(2, "changed"), (1 << 40, "added")]


def test_another_layout_is_refused(spark, rows, tmp_path):
    _table(spark, tmp_path, buckets=4).upsert(rows([(1, 1)], "k int, v int"))
    for other in ({}, {"buckets": 8}):
        with pytest.raises(ValueError, match="laid out"):
            _table(spark, tmp_path, **other).upsert(rows([(2, 1)], "k int, v int"))
    assert values(_table(spark, tmp_path).read()) == [(1, 1)]


def test_empty_and_expired(spark, rows, tmp_path):
    import datetime

    table = _table(spark, tmp_path, buckets=4)
    table.overwrite(rows([], "k int, v int"))
    table.overwrite(rows([(1, 1)], "k int, v int"))
    assert values(table.compare(0, 1)) == [(1, "added")] and values(table.compare(1, 0)) == [(1, "removed")]
    table.expire(now=datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(days=30))
    assert not (tmp_path / "summaries" / "_version=0").exists() and values(table.read()) == [(1, 1)]

import datetime
import random

import pytest
from pyspark.sql import functions as F

from frames import values
from macrospark.operators import changelog
from macrospark.operators.dedupe import dedupe_latest
from macrospark.plans import refresh, staging
from macrospark.sources.versioned import VersionedTable

UTC = datetime.timezone.utc


def at(day):
    return datetime.datetime(2024, 1, day, tzinfo=UTC)


@pytest.fixture
def kv(rows):
    return lambda data: rows(data, "k string, v int")


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), ["k"])


def test_upsert_and_time_travel(table, kv):
    assert not table.exists()
    table.upsert(kv([("a", 1), ("b", 2)]), at(1))
    table.upsert(kv([("b", 3), ("c", 4)]), at(2))
    assert values(table.read()) == [("a", 1), ("b", 3), ("c", 4)]
    assert values(table.read(version=0)) == values(table.read(at=at(1))) == [("a", 1), ("b", 2)]
    assert values(table.read(at=datetime.datetime(2024, 1, 1, 12))) == [("a", 1), ("b", 2)]
    newest = table.history(1).first()
    assert (newest.version, newest.kind, newest.inserted, newest.updated, newest.total) == (1, "merge", 1, 1, 2)
    assert values(table.compare(0, 1)) == [("b", "changed"), ("c", "added")]


def test_unknown_version_and_too_early(table, kv):
    table.upsert(kv([("a", 1)]), at(2))
    with pytest.raises(ValueError):
        table.read(version=7)
    with pytest.raises(ValueError):
        table.read(at=at(1))


def test_overwrite_starts_over_and_keeps_history(table, kv):
    table.upsert(kv([("a", 1), ("b", 2)]), at(1))
    table.overwrite(kv([("z", 9)]), at(2))
    table.upsert(kv([("y", 8)]), at(3))
    assert values(table.read()) == [("y", 8), ("z", 9)]
    assert values(table.read(version=0)) == [("a", 1), ("b", 2)]
    table.overwrite(kv([]), at(4))
    assert values(table.read()) == [] and values(table.read(version=2)) == [("y", 8), ("z", 9)]


def test_null_keys_are_added_every_time(table, kv):
    load = kv([(None, 1), ("a", 2)])
    for day in (1, 2, 3):
        table.upsert(load, at(day))
    assert values(table.read()) == [(None, 1)] * 3 + [("a", 2)]
    table.compact(at=at(4))
    assert values(table.read()) == [(None, 1)] * 3 + [("a", 2)]


def test_batch_is_written_once(table, kv):
    assert table.upsert(kv([("a", 1)]), at(1), batch="b0") == 0
    assert table.upsert(kv([("a", 2)]), at(2), batch="b0") == 0
    assert values(table.read()) == [("a", 1)]


def test_unfinished_commit_is_invisible(spark, table, kv):
    table.upsert(kv([("a", 1)]), at(1))
    left = kv([("a", 99)]).withColumn("_committed_at", F.current_timestamp())
    left.write.parquet(f"{table.path}/data/_version=1")
    assert values(table.read()) == [("a", 1)]
    table.upsert(kv([("b", 2)]), at(2))
    assert values(table.read()) == [("a", 1), ("b", 2)]


def test_later_columns(table, rows):
    table.upsert(rows([("a", 1)], "k string, v int"), at(1))
    table.upsert(rows([("b", 2, "x")], "k string, v int, w string"), at(2))
    assert values(table.read().select("k", "v", "w")) == [("a", 1, None), ("b", 2, "x")]


def test_partition_types_survive(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "p"), ["k"], ["code", "year"])
    data = rows([("a", "007", 2020, 1.5), ("b", "x", 2021, 2.5)], "k string, code string, year int, v double")
    table.upsert(data, at(1))
    table.upsert(data.filter("k = 'a'").withColumn("code", F.lit("008")), at(2))
    got = table.read().select("k", "code", "year", "v")
    assert got.schema["code"].dataType.simpleString() == "string"
    assert values(got) == [("a", "008", 2020, 1.5), ("b", "x", 2021, 2.5)]


def test_compaction_and_expiry(spark, table, kv):
    for day in range(1, 7):
        table.upsert(kv([(f"k{i}", day * 100 + i) for i in range(day, day + 20)]).repartition(5), at(day))
    before = values(table.read())
    files = len(table.read().inputFiles())
    version = table.compact(["k"], at(10))
    assert values(table.read()) == before and len(table.read().inputFiles()) < files
    assert values(table.read(version=3)) != before
    assert table.expire(now=at(16)) == []
    assert table.expire(now=at(18)) == list(range(version))
    assert values(table.read()) == before
    assert table.history(1).first().kind == "compact"
    with pytest.raises(Exception):
        table.read(version=3).collect()


def test_history_counts(table, kv):
    table.upsert(kv([("a", 1), (None, 1)]), at(1))
    table.upsert(kv([("a", 2), ("b", 2), (None, 2)]), at(2))
    table.compact(at=at(3))
    table.upsert(kv([("a", 3), ("c", 3)]), at(4))
    table.overwrite(kv([("z", 1)]), at(5))
    table.upsert(kv([("a", 4), ("z", 2)]), at(6))
    table.upsert(kv([]), at(7))
    got = [(r.version, r.kind, r.inserted, r.updated, r.total) for r in table.history().collect()]
    assert got[::-1] == [(0, "merge", 2, 0, 2), (1, "merge", 2, 1, 3), (2, "compact", 0, 0, 4), (3, "merge", 1, 1, 2),
                         (4, "overwrite", 0, 0, 1), (5, "merge", 1, 1, 2), (6, "merge", 0, 0, 0)]


def test_commit_joins_nothing(spark, table, kv):
    """A commit reads only its source."""
    table.upsert(kv([("a", 1)]), at(1))
    seen = []
    table._scan = lambda records: seen.append(records)
    table.upsert(kv([("a", 2)]), at(2))
    assert seen == []


def test_repeated_keys_are_refused_and_nothing_is_lost(table, kv):
    with pytest.raises(ValueError, match="'k': 'a'"):
        table.overwrite(kv([("a", 1), ("a", 2), ("b", 3)]), at(1))
    assert not table.exists()
    table.overwrite(kv([("a", 1), ("b", 3)]), at(1))
    with pytest.raises(ValueError):
        table.upsert(kv([("c", 1), ("c", 1)]), at(2))
    assert values(table.read()) == [("a", 1), ("b", 3)]
    table.upsert(kv([("d", 4)]), at(3))
    assert values(table.read()) == [("a", 1), ("b", 3), ("d", 4)]


def test_read_scans_once_and_prunes_partitions(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "p"), ["m"], ["year"])
    for day, v in ((1, 1), (2, 2)):
        table.upsert(rows([(f"2020-0{i}", 2020 + i, v) for i in range(1, 4)], "m string, year int, v int"), at(day))
    df = table.read(partitions=F.col("year") == 2022)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert values(df.select("m", "v")) == [("2020-02", 2)]
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(year" in plan


def test_compaction_sorts_by_whole_values(spark, tmp_path):
    ids = spark.range(1000).select(F.concat(F.lit("CES00000"), F.lpad("id", 6, "0")).alias("k"), "id")
    table = VersionedTable(spark, str(tmp_path / "c"), ["k"])
    table.upsert(ids.repartition(7), at(1))
    table.compact(["k"], at(2))
    lows = [tuple(r) for r in table.read().groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b")).select("a", "b").collect()]
    lows.sort()
    assert all(x[1] < y[0] for x, y in zip(lows, lows[1:]))


def test_random_history_against_dicts(table, kv):
    rng = random.Random(3)
    states, now = [], {}
    for day in range(1, 8):
        load = {rng.choice("abcdefgh"): rng.randrange(100) for _ in range(4)}
        if day == 4:
            table.overwrite(kv(list(load.items())), at(day))
            now = dict(load)
        else:
            table.upsert(kv(list(load.items())), at(day))
            now = {**now, **load}
        states.append(sorted(now.items()))
    for version, want in enumerate(states):
        assert values(table.read(version=version)) == want
        assert values(table.read(at=at(version + 1))) == want
    assert values(table.row_counts(range(7))) == [(v, len(s)) for v, s in enumerate(states)]
    for old, new in ((0, 2), (1, 5), (3, 6), (4, 4), (6, 2)):
        a, b = dict(states[old]), dict(states[new])
        want = {k: "added" if k not in a else "removed" if k not in b else "changed" for k in {*a, *b} if a.get(k) != b.get(k)}
        assert values(table.compare(old, new)) == sorted(want.items())


def test_compare_with_null_keys(table, kv):
    table.upsert(kv([(None, 1), ("a", None)]), at(1))
    table.upsert(kv([(None, 2), ("a", 1), ("b", None)]), at(2))
    assert values(table.compare(0, 1)) == [(None, "added"), ("a", "changed"), ("b", "added")]
    assert values(table.row_counts([0, 1])) == [(0, 2), (1, 4)]


def test_upsert_twice_is_once(kv):
    target, source = kv([("a", 1), ("b", 2)]), kv([("b", 3), ("c", 4)])
    once = changelog.upsert(target, source, ["k"])
    assert values(changelog.upsert(once, source, ["k"])) == values(once)


def test_upsert_null_keys(kv):
    target, source = kv([(None, 1), ("a", 2)]), kv([(None, 3)])
    assert values(changelog.upsert(target, source, ["k"])) == [(None, 1), (None, 3), ("a", 2)]
    assert values(changelog.upsert(target, source, ["k"], null_safe=True)) == [(None, 3), ("a", 2)]


def test_state_diff(rows):
    ddl = "k string, v int, w string"
    old = rows([("a", 1, None), ("b", 2, "x"), ("c", 3, "y"), (None, 1, "n")], ddl)
    new = rows([("a", 1, None), ("b", 2, None), ("d", 4, "z")], ddl)
    assert values(changelog.state_diff(old, new, ["k"])) == [(None, "removed"), ("b", "changed"), ("c", "removed"), ("d", "added")]


def test_retained_log_answers_late_questions(spark):
    log = spark.range(200).select(
        (F.col("id") % 9).alias("k"), F.col("id").alias("v"), F.floor(F.col("id") / 20).cast("int").alias("_version"))
    log = dedupe_latest(log, ["k", "_version"], ["v"]).withColumn("_committed_at", F.timestamp_seconds(F.col("_version") * 86400))
    kept = changelog.retain(log, ["k"], F.timestamp_seconds(F.lit(5 * 86400)))
    assert kept.count() < log.count()
    for version in range(5, 10):
        assert values(changelog.as_of_version(kept, ["k"], version)) == values(changelog.as_of_version(log, ["k"], version))


def test_run_table_and_refresh(spark, tmp_path, rows):
    ddl = "series_id string, observation_date date, value double, value_is_missing boolean, category string, ingested_at timestamp"
    day = datetime.date(2024, 1, 1)
    load = rows([("A", day, 1.0, None, "x", datetime.datetime(2024, 1, 2)), ("A", day, None, None, "x", datetime.datetime(2024, 1, 3)),
                 ("B", day, 5.0, None, "y", datetime.datetime(2024, 1, 3))], ddl)
    spec = refresh.TABLES["fred_observations"]
    staged, report = refresh.refresh_source(spark, load, spec, str(tmp_path), staging.stage_fred, datetime.datetime(2024, 1, 3, 1))
    assert [(r.series_id, r.value, r.is_missing) for r in staged.orderBy("series_id").collect()] == [("A", None, True), ("B", 5.0, False)]
    status = {(r.check, r.target): r.status for r in report.collect()}
    assert status[("not_null", "series_id")] == "pass" and status[("unique", "series_id,observation_date")] == "pass"
    assert status[("refreshed_keys", "series_id")] == "fail" and status[("freshness", "ingested_at")] == "ok"
    refresh.run_table(spark, spec, load.filter("series_id = 'B'"), str(tmp_path), "overwrite")
    assert refresh.open_table(spark, spec, str(tmp_path)).read().count() == 1
    with pytest.raises(ValueError):
        refresh.run_table(spark, spec, load, str(tmp_path), "append")
    versions = refresh.refresh_all(spark, {"fred_observations": load}, str(tmp_path), compact=True)
    assert refresh.open_table(spark, spec, str(tmp_path)).read(versions["fred_observations"]).count() == 2


def test_gate_and_increments(spark, tmp_path, rows):
    ddl = "series_id string, observation_date date, value double, value_is_missing boolean, category string, ingested_at timestamp"
    day, moment = datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 3, 1)
    spec, root = refresh.TABLES["fred_observations"], str(tmp_path)
    new = rows([("A", day, 2.0, None, "x", datetime.datetime(2024, 1, 3))], ddl)
    with pytest.raises(refresh.GateClosed):
        refresh.refresh_source(spark, new, spec, root, as_of=moment, gate=["refreshed_keys"])
    assert not refresh.open_table(spark, spec, root).exists()
    refresh.refresh_source(spark, new, spec, root, as_of=moment, gate=["freshness"])
    old = rows([("A", day, 1.0, None, "x", datetime.datetime(2024, 1, 2))], ddl)
    staged, _ = refresh.refresh_source(spark, old, spec, root, as_of=moment)  # arrives late, does not win
    assert [r.value for r in staged.collect()] == [2.0]

"""The mart after increments, document streams, and checks collected by the job that writes."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from frames import values
from macrospark.operators import calendar, quality
from macrospark.plans import incremental, marts, refresh, staging
from macrospark.sources import sinks
from macrospark.streaming import documents

D = datetime.date
DDL = "series_id string, observation_date date, value double, value_is_missing boolean, category string, ingested_at timestamp"


def load(rows, seed, at, series=("CPIAUCSL", "PAYEMS", "GDP", "UNRATE", "OTHER"), n=60):
    rng = random.Random(seed)
    data = {}
    for _ in range(n):
        key = rng.choice(series), D(2018 + rng.randrange(4), rng.randrange(1, 13), rng.randrange(1, 28))
        data[key] = (*key, rng.choice([None, round(rng.uniform(1, 9), 2)]), None, "x", at)
    return rows(list(data.values()), DDL)


@pytest.mark.parametrize("seed", range(2))
def test_increments_equal_the_full_rebuild(spark, rows, tmp_path, seed):
    months = calendar.spine(spark, D(2018, 1, 1), D(2022, 6, 1))
    root, spec = str(tmp_path), refresh.TABLES["fred_observations"]
    mart_spec = refresh.TABLES["macro_indicators_monthly"]
    for i, n in enumerate((80, 3, 5)):
        table = refresh.open_table(spark, spec, root)
        before = table.last_version()
        refresh.run_table(spark, spec, load(rows, seed * 10 + i, datetime.datetime(2024, 1, 1 + i), n=n), root)
        changed = table.changes(before).select("series_id", "observation_date")
        staged = staging.stage_fred(table.read())
        version = incremental.refresh_mart_increment(spark, staged, changed, months, root)
        mart = refresh.open_table(spark, mart_spec, root)
        want = marts.monthly_mart(staged, months)
        assert values(mart.read().select(*want.columns), "observation_month") == values(want, "observation_month")
        written = mart.changes(version - 1).count()
        assert written == 54 if i == 0 else written <= 2 * n


def test_affected_months(rows):
    changed = rows([("CPIAUCSL", D(2020, 3, 5)), ("PAYEMS", D(2020, 3, 9)), ("GDP", D(2020, 6, 1)), ("UNRATE", D(2020, 1, 31)), ("OTHER", D(2020, 9, 1)), (None, None)],
                   "series_id string, observation_date date")
    months = [m for (m,) in values(incremental.affected_periods(changed))]
    assert months == [D(2020, 1, 1), D(2020, 3, 1), D(2020, 4, 1), D(2021, 3, 1)]


def test_observed_checks_equal_the_plain_ones(spark, rows, tmp_path):
    now = datetime.datetime(2024, 1, 3, 1)
    df = rows([("A", 1, now), ("B", None, now), (None, 3, datetime.datetime(2024, 1, 2)), ("C", 9, None)], "k string, v int, at timestamp")
    observed = quality.Observed(df, "df", ["k", "v"], {"v": [1, 3]}, key="k", at="at", as_of=F.lit(now))
    sinks.write_parquet(observed.rows, str(tmp_path / "rows"))
    plain = quality.check_non_empty(df, "df")
    for check in (
        quality.check_not_null(df, ["k", "v"]), quality.check_accepted_values(df, "v", [1, 3]),
        quality.check_refreshed(df, "k", "at", F.lit(now)), quality.check_freshness(df, "at", F.lit(now)),
    ):
        plain = plain.unionByName(check)
    assert values(observed.report()) == values(plain)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 4
    nothing = quality.Observed(df.limit(0), "none", ["k"], at="at", as_of=F.lit(now))
    sinks.write_parquet(nothing.rows, str(tmp_path / "none"))
    assert {r["check"]: r["status"] for r in nothing.report().collect()} == {"non_empty": "fail", "not_null": "pass", "freshness": "error"}


def test_keyed_checks_in_one_pass(rows):
    df = rows([("a", 1, None), ("a", 1, 2), (None, 1, 3), (None, 1, 3)], "k string, n int, v int")
    plain = quality.check_not_null(df, ["k", "v"]).unionByName(quality.check_unique(df, ["k", "n"]))
    one = quality.check_keyed(df, ["k", "n"], ["k", "v"])
    assert values(one) == values(plain)
    assert one._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_refresh_computes_new_rows_once(spark, rows, tmp_path):
    """The rows of a load are computed by the write of the raw log, and by nothing else."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    new = load(rows, 1, datetime.datetime(2024, 1, 3)).cache()
    n = new.count()
    refresh.refresh_source(
        spark, new.mapInArrow(count, new.schema), refresh.TABLES["fred_observations"], str(tmp_path), as_of=datetime.datetime(2024, 1, 3, 1), gate=["freshness"]
    )
    assert seen.value == n


def test_second_run_reads_new_documents_only(spark, tmp_path):
    root, source = str(tmp_path), documents.SOURCES["fred"]

    def land(day, **observations):
        docs = [("gdp", '{"observations":[%s]}' % ",".join(f'{{"date":"{k[1:]}","value":"{v}"}}' for k, v in observations.items())), ("gdp", '{"error":%d}' % day), ("gdp", "{no json")]
        return sinks.archive_json(spark, spark.createDataFrame(docs, "indicator string, payload string"), root, "fred", D(2024, 1, day))

    folder = land(1, d20200101="1.5", d20200401=".")
    table = documents.ingest_documents(spark, folder, source, root, f"{root}/checkpoint")
    land(2, d20200401="2.5", d20200701="7")
    table = documents.ingest_documents(spark, folder, source, root, f"{root}/checkpoint")
    assert table.changes(0).count() == 2 and table.last_version() == 1
    got = values(table.read().select("series_id", "observation_date", "value", F.col("ingested_at").cast("date")))
    assert got == [("GDP", D(2020, 1, 1), 1.5, D(2024, 1, 1)), ("GDP", D(2020, 4, 1), 2.5, D(2024, 1, 2)), ("GDP", D(2020, 7, 1), 7.0, D(2024, 1, 2))]
    bad = spark.read.parquet(f"{root}/quarantine/fred_observations")
    assert bad.groupBy("error").count().count() == 2 and bad.count() == 4
    documents.ingest_documents(spark, folder, source, root, f"{root}/checkpoint")
    assert table.last_version() == 1

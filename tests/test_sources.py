import datetime
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from frames import values
from macrospark.plans import normalize
from macrospark.session import new_run_dir, shared_dir
from macrospark.sources import dims, json_docs, sinks, tables

DAY = datetime.date(2024, 3, 5)


def land(spark, rows, path, source, docs):
    return sinks.archive_json(spark, rows([(i, json.dumps(d) if not isinstance(d, str) else d) for i, d in docs], "indicator string, payload string"), str(path), source, DAY)


def test_fred_documents(spark, rows, tmp_path):
    docs = [("unrate", {"observations": [{"date": "2020-01-01", "value": "3.5"}, {"date": "2020-02-01", "value": "."}, {"date": "soon", "value": "1"}]}),
            ("gdp", {"error": "none"}), ("gdp", '{"observations": [{"da')]
    records, bad = json_docs.read_fred_json(spark, land(spark, rows, tmp_path, "fred", docs))
    good, rejected = normalize.normalize_fred(records, dims.fred_series_dim(spark))
    assert values(good.select("series_id", "observation_date", "value", "value_is_missing", "category")) == [
        ("UNRATE", datetime.date(2020, 1, 1), 3.5, False, "labor"), ("UNRATE", datetime.date(2020, 2, 1), None, True, "labor")]
    assert len(good.columns) == 12 and rejected.count() == 1
    assert values(bad) == [("gdp", "no observations"), ("gdp", "unreadable document")]


def test_bea_documents(spark, rows, tmp_path):
    data = [{"LineNumber": "1", "TimePeriod": "2023Q1", "DataValue": "27,360.4", "LineDescription": "GDP"},
            {"LineNumber": "3", "TimePeriod": "2023Q1", "DataValue": "1"}, {"LineNumber": "2", "TimePeriod": "2023Q9", "DataValue": "1"},
            {"LineNumber": "2", "TimePeriod": "2023Q2", "DataValue": "(D)"}, {"LineNumber": "x", "TimePeriod": "2023Q2", "DataValue": "2"}]
    docs = [("gdp_and_components", {"table_key": "gdp_and_components", "data": data[:2]}),
            ("gdp_and_components", {"BEAAPI": {"Results": {"Data": data[2:]}}}),
            ("fixed_assets", {"BEAAPI": {"Results": {"Error": {"code": "1"}}}}), ("fixed_assets", {"oops": 1})]
    records, bad = json_docs.read_bea_json(spark, land(spark, rows, tmp_path, "bea", docs))
    good, rejected = normalize.normalize_bea(records, dims.bea_line_dim(spark))
    assert values(good.select("series_name", "period_date", "value", "is_missing", "bea_table_name")) == [
        ("gdp", datetime.date(2023, 1, 1), 27360.4, False, "T10105"),
        ("personal_consumption_expenditures", datetime.date(2023, 4, 1), None, True, "T10105")]
    assert [r.TimePeriod for r in rejected.collect()] == ["2023Q9"] and len(good.columns) == 15
    assert values(bad) == [("fixed_assets", "no BEAAPI element"), ("fixed_assets", '{"code": "1"}')]


def test_bls_documents(spark, rows, tmp_path):
    points = [{"year": "2023", "period": "M01", "periodName": "January", "value": "5.1", "footnotes": [{"code": "P"}, {}, {"code": "R"}]},
              {"year": "2023", "period": "M13", "value": "5"}, {"year": "2023", "period": "X01", "value": "5"}, {"year": "2023", "period": "Q02", "value": "-"}]
    docs = [("bulk", {"status": "REQUEST_SUCCEEDED", "Results": {"series": [{"seriesID": "LNS14000000", "data": points}]}}),
            ("bulk", {"series": [{"seriesID": "OTHER", "data": points[3:]}], "start_year": 2023, "end_year": 2023}),
            ("bulk", {"status": "REQUEST_FAILED", "message": ["quota"]}), ("bulk", {"message": []})]
    records, bad = json_docs.read_bls_json(spark, land(spark, rows, tmp_path, "bls", docs))
    good, rejected = normalize.normalize_bls(records, dims.bls_series_dim(spark))
    q2 = datetime.date(2023, 4, 1)
    assert values(good.select("series_id", "observation_date", "value", "footnote_codes", "frequency", "category")) == [
        ("LNS14000000", datetime.date(2023, 1, 1), 5.1, "P,R", "monthly", "labor"),
        ("LNS14000000", q2, None, None, "monthly", "labor"), ("OTHER", q2, None, None, "quarterly", "unknown")]
    assert [r.period for r in rejected.collect()] == ["X01"] and len(good.columns) == 18
    assert values(bad) == [("bulk", "REQUEST_FAILED: quota"), ("bulk", "no status")]


def test_dimensions_are_broadcast(spark, rows):
    assert [d.count() for d in (dims.fred_series_dim(spark), dims.bea_line_dim(spark), dims.bls_series_dim(spark))] == [22, 58, 8]
    records = spark.range(5).select(F.when(F.col("id") > 2, "GDP").otherwise("UNRATE").alias("series_id"), F.lit("2020-01-01").alias("date"), F.lit("1").alias("value"))
    good, _ = normalize.normalize_fred(records, dims.fred_series_dim(spark))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan and "Python" not in plan


def test_landing_twice_adds_nothing(spark, rows, tmp_path):
    docs = [("a", {"x": 1}), ("a", {"x": 1}), ("b", {"x": 1}), ("a", {"x": 2})]
    path = land(spark, rows, tmp_path, "s", docs)
    assert spark.read.text(path).count() == 3
    land(spark, rows, tmp_path, "s", docs + [("a", {"x": 3})])
    assert spark.read.text(path).count() == 4
    assert (tmp_path / "raw/s/indicator=a/year=2024/month=03/day=05").is_dir()


def test_documents_over_several_lines(spark, rows, tmp_path):
    doc = json.dumps({"observations": [{"date": "2020-01-01", "value": "1"}, {"date": "2020-02-01", "value": "2"}]}, indent=2)
    for _ in range(2):
        path = land(spark, rows, tmp_path, "fred", [("gdp", doc)])
    records, bad = json_docs.read_fred_json(spark, path)
    assert values(records) == [("GDP", "2020-01-01", "1"), ("GDP", "2020-02-01", "2")] and bad.isEmpty()


def test_day_is_replaced(spark, tmp_path):
    for n, day in ((3, DAY), (5, DAY + datetime.timedelta(1)), (2, DAY)):
        path = sinks.archive_parquet(spark.range(n), str(tmp_path), "s", "i", day)
    assert sorted(r[0] for r in spark.read.parquet(path).groupBy("day").count().select("count").collect()) == [2, 5]


def test_dispositions(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.load_raw(spark.range(2), path)
    sinks.load_raw(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4
    sinks.load_raw(spark.range(2), path, "replace")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        sinks.load_raw(spark.range(2), path, "merge")


def test_csv_has_headers(spark, rows, tmp_path):
    df = rows([("a,b", 1.5), (None, 2.0)], "s string, v double")
    sinks.export_csv(df, str(tmp_path / "c"))
    for part in (tmp_path / "c").glob("*.csv"):
        assert part.read_text().startswith("s,v\n")
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "c"))
    assert values(back) == values(df)


def test_materialize(spark, rows, tmp_path):
    df = rows([(1,)], "x int")
    sinks.materialize(df, "m_view")
    sinks.materialize(df, "m_table", "table", str(tmp_path / "m"))
    assert spark.table("m_view").count() == spark.table("m_table").count() == 1
    assert spark.table("m_table").inputFiles() and not spark.table("m_view").inputFiles()
    for bad in ({"as_": "index"}, {"as_": "table"}):
        with pytest.raises(ValueError):
            sinks.materialize(df, "m", **bad)


def test_views_skip_what_is_absent(spark, tmp_path):
    sinks.overwrite_table(spark.range(6).withColumn("g", F.col("id") % 2), str(tmp_path / "t"), ["g"])
    assert tables.register_tables(spark, {"here": str(tmp_path / "t"), "gone": str(tmp_path / "no")}) == ["here"]
    assert spark.sql("select count(*) from here where g = 1").first()[0] == 3
    plan = spark.table("here").filter("g = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(g" in plan


def test_hot_partition_value_is_split(spark, tmp_path):
    """Nearly all rows have one partition value; more than one task writes it."""
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "64k")
    try:
        df = spark.range(200_000, numPartitions=8).select(F.xxhash64("id").alias("x"), F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("g"))
        sinks.overwrite_table(df, str(tmp_path / "h"), ["g"])
    finally:
        spark.conf.set(conf, old)
    assert len(list((tmp_path / "h/g=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "h")).count() == 200_000


def test_jdbc_options():
    read = tables.jdbc_options("jdbc:x", "raw.t", "u", "p", "drv", ("id", 0, 100, 8))
    assert read == {"url": "jdbc:x", "dbtable": "raw.t", "fetchsize": "10000", "user": "u", "password": "p", "driver": "drv",
                    "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}
    assert tables.jdbc_write_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t", "batchsize": "1000"}


def session(master, folder):
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=context)


def test_shared_folder_comes_from_the_session():
    on_cluster = session("spark://host:7077", "s3a://shared/here/")
    assert shared_dir(on_cluster) == "s3a://shared/here"
    a, b = new_run_dir(on_cluster, "x"), new_run_dir(on_cluster, "x")
    assert a != b and a.startswith("s3a://shared/here/")
    with pytest.raises(ValueError):
        shared_dir(session("yarn", None))
    assert shared_dir(session("local[2]", None)) == shared_dir(session("local[2]", None))


def test_files_in_any_folder_are_read(spark, tmp_path):
    path = str(tmp_path / "deep")
    for i, folder in enumerate(["", "/2024", "/2024/05"]):
        spark.range(i * 10, i * 10 + 3 + i).write.mode("append").parquet(path + folder)
    assert tables.read_table(spark, path).count() == 12
    spark.range(7).withColumn("g", F.col("id") % 2).write.partitionBy("g").parquet(str(tmp_path / "hive"))
    hive = tables.read_table(spark, str(tmp_path / "hive"))
    assert hive.columns == ["id", "g"] and hive.count() == 7


def test_documents_without_data_are_quarantined(spark, tmp_path):
    path = tmp_path / "bea" / "indicator=t"
    path.mkdir(parents=True)
    docs = [{"BEAAPI": {}}, {"BEAAPI": {"Results": {}}}, {"BEAAPI": {"Results": {"Error": "no"}}}, {"data": [{"LineNumber": "1"}]}]
    (path / "d.json").write_text("\n".join(json.dumps(d) for d in docs))
    rows, bad = json_docs.read_bea_json(spark, str(tmp_path / "bea"))
    assert rows.count() == 1 and sorted(r.error for r in bad.collect()) == ["no", "no data", "no data"]

import datetime

import pytest
from pyspark.sql import functions as F

from frames import values
from macrospark.operators import calendar
from macrospark.plans import marts, staging

D = datetime.date
START, END = D(2020, 1, 1), D(2020, 12, 1)


def fred(rows, data):
    """Bronze rows from (series, date, value, vintage)."""
    full = [(s, d, v, None, datetime.datetime(2021, 1, at)) for s, d, v, at in data]
    return rows(full, "series_id string, observation_date date, value double, value_is_missing boolean, ingested_at timestamp")


def mart_of(spark, bronze, end=END):
    return marts.monthly_mart(staging.stage_fred(bronze), calendar.spine(spark, START, end))


def test_withdrawn_value_does_not_come_back(spark, rows):
    bronze = fred(rows, [("UNRATE", START, 5.0, 1), ("UNRATE", START, None, 2)])
    assert mart_of(spark, bronze).filter("unemployment_rate is not null").isEmpty()


def test_quarterly_value_stands_on_the_first_month(spark, rows):
    bronze = fred(rows, [("GDP", D(2020, 4, 1), 7.0, 1)])
    got = {r.month: r.gdp_billions_usd for r in mart_of(spark, bronze).collect()}
    assert got[4] == 7.0 and got[5] is None and got[6] is None


def test_several_days_of_a_month_give_the_latest(spark, rows):
    bronze = fred(rows, [("UNRATE", D(2020, 1, 5), 1.0, 1), ("UNRATE", D(2020, 1, 20), 2.0, 1)])
    mart = mart_of(spark, bronze)
    assert mart.count() == 12 and mart.filter("month = 1").first().unemployment_rate == 2.0


def test_mart_shape(spark, rows):
    mart = marts.monthly_mart(
        staging.stage_fred(fred(rows, [("GDP", START, 1.0, 1)])), calendar.spine(spark, START, END),
        updated_at=F.current_timestamp())
    assert len(mart.columns) == 25
    assert mart.columns[:4] == ["observation_month", "year", "month", "quarter"] and mart.columns[-1] == "updated_at"


def test_completeness_needs_three_columns(spark, rows):
    data = [(s, START, 1.0, 1) for s in ("CPIAUCSL", "UNRATE", "FEDFUNDS")] + [(s, D(2020, 2, 1), 1.0, 1) for s in ("CPIAUCSL", "UNRATE", "GDP")]
    got = {r.month: r.is_complete_record for r in mart_of(spark, fred(rows, data)).collect()}
    assert got[1] is True and got[2] is False and got[3] is False


def signal_mart(spark, rows):
    data = []
    for m in range(1, 13):
        day = D(2020, m, 1)
        data += [("CPIAUCSL", day, 100.0, 1), ("FEDFUNDS", day, 1.0, 1), ("UNRATE", day, 3.0 if m < 7 else 5.0, 1)]
        if m in (1, 4, 7, 10):
            data.append(("GDPC1", day, 1000.0 - m, 1))
    return mart_of(spark, fred(rows, data))


def test_signal_rule_by_rows(spark, rows):
    got = marts.recession_signals(signal_mart(spark, rows)).orderBy("observation_month").collect()
    assert [r.observation_month.month for r in got] == [7, 8, 9]
    assert all(r.gdp_qoq_change is None and r.recession_risk_flag is False for r in got)


def test_signal_rule_by_quarters(spark, rows):
    got = marts.recession_signals_by_quarter(signal_mart(spark, rows)).orderBy("observation_month").collect()
    assert [r.observation_month.month for r in got] == list(range(4, 13))
    assert [r.observation_month.month for r in got if r.recession_risk_flag] == [7, 8, 9]


def test_staging_reads_text_dates(rows):
    df = rows([("a", "2020-03-05", 1.0, None, datetime.datetime(2021, 1, 1))],
              "series_id string, observation_date string, value double, value_is_missing boolean, ingested_at timestamp")
    got = staging.stage_fred(df).first()
    assert (got.observation_date, got.observation_month, got.observation_quarter) == (D(2020, 3, 5), D(2020, 3, 1), D(2020, 1, 1))


def test_summary(rows):
    table, pce = "gdp_and_components", "personal_consumption_expenditures"
    bea = rows([(table, "gdp", D(2020, 1, 1), 5.0), (table, pce, D(2020, 4, 1), 6.0), (table, "exports", D(2020, 2, 1), 1.0),
                ("personal_income_saving", pce, D(2020, 4, 1), 100.0), ("personal_income_saving", pce, D(2020, 5, 1), 7.0)],
               "table_key string, series_name string, period_date date, value double")
    money = rows([("T10Y2Y", D(2020, 1, 3), 1.0), ("T10Y2Y", D(2020, 1, 30), -0.5), ("T10Y2Y", D(2020, 1, 31), None), ("M2SL", D(2020, 2, 1), 9.0)],
                 "series_id string, observation_date date, value double")
    got = {r.month.month: r for r in marts.macro_summary(bea=bea, fred=money).collect()}
    assert sorted(got) == [1, 2, 4]
    assert got[1].gdp_billions == 5.0 and got[1].yield_curve_spread == -0.5 and got[1].yield_curve_inverted is True
    assert got[4].pce_billions == 6.0 and got[4].yield_curve_inverted is False and got[2].m2_billions == 9.0


def test_summary_comes_with_its_checks(rows):
    bea = rows([("gdp_and_components", "gdp", D(2020, 1, 1), 5.0)], "table_key string, series_name string, period_date date, value double")
    money = rows([(s, D(2020, 1, 3), 1.0) for s in marts.SUMMARY_FRED], "series_id string, observation_date date, value double")
    summary, report = marts.checked_summary(bea=bea, fred=money)
    status = {(r.check, r.target): r.status for r in report.collect()}
    assert summary.count() == 1 and status[("required_members", "series_id")] == "pass"
    assert status[("required_members", "series_name")] == "fail" and status[("non_empty", "gdp_and_components")] == "pass"


def test_a_named_feature_without_its_columns_is_an_error(spark, rows):
    mart = mart_of(spark, fred(rows, [("FEDFUNDS", START, 2.0, 1)]))
    with pytest.raises(ValueError, match="yield_curve_spread"):
        marts.derived_features(mart, names=["yield_curve_inverted"])


def test_derived_only_where_columns_are_there(spark, rows):
    mart = mart_of(spark, fred(rows, [("FEDFUNDS", START, 2.0, 1)]))
    names = set(marts.derived_features(mart).columns) - set(mart.columns)
    assert names == {"core_cpi_yoy_pct", "real_fed_funds_rate", "payrolls_mom_change_thousands", "real_gdp_qoq_pct"}


@pytest.mark.parametrize("by", [["e"], ["e", "f"]])
def test_entity_mart_equals_one_mart_per_entity(spark, rows, by):
    spec = marts.MartSpec(series={"s": "s"}, yoy={"s": "s_yoy"}, change={"s": "s_mom"}, complete=("s",))
    data = [(e, 1, "s", D(2019 + (m // 12), m % 12 + 1, 1), float(10 * e + m)) for e in (1, 2) for m in range(0, 26, e)]
    df = rows(data, "e int, f int, series_id string, observation_date date, value double").withColumns({
        "observation_month": F.trunc("observation_date", "month"), "observation_quarter": F.trunc("observation_date", "quarter"), "is_missing": F.lit(False)})
    together = marts.monthly_mart(df, None, spec, by)
    for e in (1, 2):
        own = marts.monthly_mart(df.filter(F.col("e") == e), calendar.spine_of(df.filter(F.col("e") == e), "observation_date"), spec)
        assert values(together.filter(F.col("e") == e).drop(*by)) == values(own)

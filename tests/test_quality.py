import datetime

import pytest
from pyspark.sql import functions as F

from macrospark.operators import quality


def one(report):
    found = report.collect()
    assert len(found) == 1 and report.columns == ["check", "target", "observed", "threshold", "status"]
    return found[0].observed, found[0].status


def test_not_null_in_one_pass(rows):
    df = rows([("a", 1), (None, None), ("b", None)], "s string, v int")
    got = {r.target: (r.observed, r.status) for r in quality.check_not_null(df, ["s", "v"]).collect()}
    assert got == {"s": (1.0, "fail"), "v": (2.0, "fail")}
    assert quality.passed(quality.check_not_null(df.filter("v = 1"), ["s", "v"]))
    assert not quality.passed(quality.check_not_null(df, ["s"]))


def test_unique(rows):
    df = rows([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "s string, v int")
    assert one(quality.check_unique(df, ["s", "v"])) == (1.0, "fail")
    assert one(quality.check_unique(df.filter("v = 2"), ["s"])) == (0.0, "pass")


def test_accepted(rows):
    df = rows([("a",), ("z",), (None,)], "s string")
    assert one(quality.check_accepted_values(df, "s", ["a", "b"])) == (1.0, "fail")
    assert one(quality.check_accepted_values(df, "s", ["a", "z"])) == (0.0, "pass")


@pytest.mark.parametrize("days, status", [(0.5, "ok"), (2, "warn"), (4, "error"), (None, "error")])
def test_freshness(rows, days, status):
    now = datetime.datetime(2024, 1, 10)
    data = [] if days is None else [(now - datetime.timedelta(days=days),), (now - datetime.timedelta(days=90),)]
    assert one(quality.check_freshness(rows(data, "t timestamp_ntz"), "t", F.lit(now).cast("timestamp_ntz"))) == (days, status)


def test_refreshed(rows):
    now = datetime.datetime(2024, 1, 10, 12)
    data = [(f"s{i}", now - datetime.timedelta(minutes=30 * i)) for i in range(8)]
    df = rows(data, "s string, t timestamp")
    assert one(quality.check_refreshed(df, "s", "t", F.lit(now))) == (5.0, "pass")
    assert one(quality.check_refreshed(df.filter("s <> 's0'"), "s", "t", F.lit(now))) == (4.0, "fail")


def test_input_checks(rows):
    df = rows([("a", 1.0), ("b", None)], "s string, v double")
    assert one(quality.check_non_empty(df, "d"))[1] == "pass"
    assert one(quality.check_non_empty(df.limit(0), "d"))[1] == "fail"
    assert one(quality.check_non_null_ratio(df, "v")) == (0.5, "fail")
    assert one(quality.check_non_null_ratio(df, "s")) == (1.0, "pass")
    assert one(quality.check_non_null_ratio(df.limit(0), "v")) == (None, "fail")
    assert one(quality.check_members(df, "s", ["a", "q"])) == (1.0, "fail")
    assert [r.status for r in quality.check_columns(df, ["s", "w"]).collect()] == ["pass", "fail"]


def test_future(rows):
    df = rows([(datetime.date(2024, 1, 5),)], "d date")
    assert one(quality.check_no_future(df, "d", F.lit("2024-01-05").cast("date"))) == (0.0, "pass")
    assert one(quality.check_no_future(df, "d", F.lit("2024-01-02").cast("date"))) == (3.0, "fail")
    assert one(quality.check_no_future(df.limit(0), "d", F.lit("2024-01-02").cast("date")))[1] == "pass"

import datetime
import math

import pytest
from pyspark.sql import functions as F

from frames import values
from macrospark.functions import scalars as S
from macrospark.functions.sql import register_functions

D = datetime.date

COMPACT = [
    ("2023", "A", D(2023, 1, 1)),
    ("2023Q1", "Q", D(2023, 1, 1)),
    ("2023Q4", "Q", D(2023, 10, 1)),
    ("2023M07", "M", D(2023, 7, 1)),
    ("2023M1", "M", D(2023, 1, 1)),
    ("2023Q5", "Q", None),
    ("2023M13", "M", None),
    ("2023M00", "M", None),
    ("2023M", "M", None),
    ("", "A", None),
    ("2023", "W", None),
    ("abcd", "A", None),
    ("abcdQ1", "Q", None),
    (None, "A", None),
    ("2023", None, None),
]
CODED = [
    ("2023", "M01", D(2023, 1, 1)),
    ("2023", "M12", D(2023, 12, 1)),
    ("2023", "M13", None),
    ("2023", "M00", None),
    ("2023", "M1", D(2023, 1, 1)),
    ("2023", "m02", D(2023, 2, 1)),
    ("2023", "Q03", D(2023, 7, 1)),
    ("2023", "Q05", None),
    ("2023", "A01", D(2023, 1, 1)),
    ("2023", "S01", D(2023, 1, 1)),
    ("2023", "S02", D(2023, 7, 1)),
    ("2023", "S03", None),
    ("2023", "M", None),
    ("2023", "A", None),
    ("", "M01", None),
    ("2023", "X01", None),
    ("2023", "Mxx", None),
    (None, "M01", None),
    ("2023", None, None),
]
NUMBERS = [
    ("1.5", 1.5), ("-2", -2.0), ("+.5", 0.5), ("1e3", 1000.0), (" 7 ", 7.0), ("inf", math.inf), ("-Infinity", -math.inf),
    ("nan", None), ("abc", None), ("1_000", None), ("1.5d", None), ("2f", None), ("0x10", None), ("", None), ("1,5", None), (None, None),
]


def test_compact_periods(rows):
    df = rows(COMPACT, "p string, f string, want date")
    assert values(df.filter(~S.parse_period_compact("p", "f").eqNullSafe(F.col("want")))) == []


def test_coded_periods(rows):
    df = rows(CODED, "y string, p string, want date")
    assert values(df.filter(~S.parse_period_coded("y", "p").eqNullSafe(F.col("want")))) == []


def test_numbers(rows):
    df = rows(NUMBERS, "x string, want double")
    assert values(df.filter(~S.safe_double("x").eqNullSafe(F.col("want")))) == []


def test_thousands(rows):
    df = rows([("27,360.4", 27360.4), ("1,234,567", 1234567.0), ("(D)", None)], "x string, want double")
    assert values(df.filter(~S.parse_thousands("x").eqNullSafe(F.col("want")))) == []


def test_sql_functions_agree_with_columns(spark, rows):
    register_functions(spark)
    compact = rows(COMPACT, "p string, f string, want date").withColumn("got", F.expr("period_date(p, f)"))
    coded = rows(CODED, "y string, p string, want date").withColumn("got", F.expr("code_date(y, p)"))
    numbers = rows(NUMBERS, "x string, want double").withColumn("got", F.expr("safe_double(x)"))
    for df in (compact, coded, numbers):
        assert values(df.filter(~F.col("got").eqNullSafe(F.col("want")))) == []


@pytest.mark.parametrize("tokens", [S.FRED_MISSING, S.BEA_MISSING, S.BLS_MISSING])
def test_missing_marks(rows, tokens):
    df = rows([(t,) for t in tokens], "x string")
    assert df.filter(S.missing_to_null("x", tokens).isNotNull()).isEmpty()
    # the number parsers alone read the marks as unknown, too
    assert df.filter(S.safe_double("x").isNotNull() | S.parse_thousands("x").isNotNull()).isEmpty()
    kept = rows([("5",), (None,)], "x string").select(S.missing_to_null("x", tokens).alias("x"))
    assert values(kept) == [(None,), ("5",)]


def test_frequency(rows):
    df = rows([("M01", "monthly"), ("q1", "quarterly"), ("A01", "annual"), ("S01", "semi_annual"), ("X", "unknown"), ("", "unknown"), (None, "unknown")],
              "p string, want string")
    assert values(df.filter(~S.infer_frequency("p").eqNullSafe(F.col("want")))) == []


def test_footnotes(rows):
    ddl = "id int, notes array<struct<code: string>>"
    df = rows([(1, [("P",), (None,), ("R",)]), (2, [(None,)]), (3, []), (4, None), (5, [("",), ("P",)])], ddl)
    assert values(df.select("id", S.join_codes("notes").alias("codes"))) == [(1, "P,R"), (2, None), (3, None), (4, None), (5, "P")]


def test_missing_flag(rows):
    df = rows([(None, None, True), (None, 1.0, False), (False, None, False), (True, 1.0, True)], "f boolean, v double, want boolean")
    assert values(df.filter(S.missing_flag("f", "v") != F.col("want"))) == []


def test_negative_flag(rows):
    df = rows([(None, False), (-1.0, True), (0.0, False)], "x double, want boolean")
    assert values(df.filter(S.negative_flag("x") != F.col("want"))) == []


def test_dates(rows):
    df = rows(
        [("2023-05-06", D(2023, 5, 6)), ("2023-05-06T07:08:09", D(2023, 5, 6)), ("2023-05-06 07:08:09.123Z", D(2023, 5, 6)),
         ("20230506", D(2023, 5, 6)), ("05/06/2023", D(2023, 5, 6)), ("2023-05", D(2023, 5, 1)),
         ("2023-13-01", None), ("2023-02-30", None), ("soon", None), ("2023-05-06Tx", None), (None, None)],
        "x string, want date")
    assert values(df.filter(~S.normalize_date("x").eqNullSafe(F.col("want")))) == []


def test_dates_of_any_shape(rows):
    import pandas as pd

    texts = [
        "2020/1/5", "2020.01.05", "2020-1-5", "1/5/2020", "01-05-2020", "13/2/2020", "1.5.2020", "2020/05", "5/2020", "2020", "January 5, 2020", "Jan 5 2020",
        "Jan. 5, 2020", "5 January 2020", "05-Jan-2020", "5 Sept 2020", "May 2020", "2020-Jan-05", "2020-01-05 10:30", "1/5/2020 3:04 PM", "2020-01-05T10:30:00.25Z",
        "January 5, 2020 10:30:00", "20200105", "2020 Mar 7", " 2020-02-29 ", "2019/2/29", "32/13/2020", "Foo 5, 2020", "Januar 5, 2020", "yesterday", "", "n/a", "12345", "1:30",
    ]
    got = {r["x"]: r["d"] for r in rows([(t,) for t in texts], "x string").select("x", S.normalize_date("x").alias("d")).collect()}
    for text in texts:
        try:
            want = None if text in ("", "yesterday", "n/a", "12345", "1:30") else pd.to_datetime(text).date()
        except ValueError:
            want = None
        assert got[text] == want, text


def test_numeric_year(rows):
    df = rows([("2023", 2023), ("2023-", None), ("", None), (None, None)], "x string, want int")
    assert values(df.filter(~S.numeric_year("x").eqNullSafe(F.col("want")))) == []


def test_content_hash(rows):
    import hashlib

    df = rows([("abc",)], "x string").select(S.content_hash("x"))
    assert df.first()[0] == hashlib.md5(b"abc").hexdigest()[:8]


def test_dates_of_any_shape_are_taken_apart_once(spark):
    day = S.normalize_date(F.date_format(F.current_timestamp(), "d MMM yyyy")).alias("day")
    plan = spark.range(1).select(day)._jdf.queryExecution().analyzed().toString()
    assert [plan.count(f"{name}(") for name in ("regexp_extract_all", "date_format")] == [1, 1]

import datetime
import math
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import values
from macrospark.operators import calendar, features, joins, pivot, rollup, select
from macrospark.operators.dedupe import dedupe_latest, latest_values

D = datetime.date


def month(n):
    return D(2020 + n // 12, n % 12 + 1, 1)


def series(rows, xs, name="x"):
    return rows([(month(i), x) for i, x in enumerate(xs)], f"m date, {name} double")


def test_newest_vintage_wins_even_when_missing(rows):
    df = rows([("a", D(2020, 1, 1), 1, 5.0), ("a", D(2020, 1, 1), 2, None)], "k string, d date, at int, v double")
    newest = dedupe_latest(df, ["k", "d"], ["at"])
    assert values(newest) == [("a", D(2020, 1, 1), 2, None)]
    assert newest.filter("v is not null").isEmpty()


def test_dedupe_is_repeatable_and_total(spark):
    df = spark.range(1000).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("at"), F.xxhash64("id").alias("v"), F.lit(None).cast("map<string,int>").alias("m"))
    a = values(dedupe_latest(df, ["k"], ["at"]).drop("m"))
    b = values(dedupe_latest(df.repartition(5), ["k"], ["at"]).drop("m"))
    assert a == b and len(a) == 7
    twice = dedupe_latest(dedupe_latest(df, ["k"], ["at"]), ["k"], ["at"])
    assert values(twice.drop("m")) == a
    assert values(latest_values(df, ["k"], ["v"], ["at", "v"])) == [(k, v) for k, _, v in a]


def test_dedupe_limits_a_hot_key_ahead_of_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"))
    plan = dedupe_latest(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_yoy(rows):
    xs = [100.0, 0.0, None] + [1.0] * 9 + [102.345, 5.0, 7.0]
    got = [r[1] for r in values(series(rows, xs).select("m", features.yoy_pct("x", [], "m").alias("y")))]
    assert got[:12] == [None] * 12
    assert [None if g is None else float(g) for g in got[12:]] == [2.35, None, None]


def test_yoy_of_infinity_is_unknown(rows):
    xs = [1.0] * 12 + [math.inf]
    assert values(series(rows, xs).select("m", features.yoy_pct("x", [], "m").alias("y")))[-1][1] is None


def test_padded_change(rows):
    df = features.with_pct_change(series(rows, [100.0, None, 110.0, 0.0, 5.0]), "x", "c", 1, [], "m")
    got = [r[2] for r in values(df)]
    assert got[0] is None and got[1] == 0.0 and got[2] == pytest.approx(0.1)
    assert got[3] == -1.0 and got[4] == math.inf


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.sampled_from([0.0, 1.0, -2.5, 3.25, 100.0])), min_size=1, max_size=30), st.integers(1, 13))
def test_padded_change_like_pandas(rows, xs, n):
    got = [r[2] for r in values(features.with_pct_change(series(rows, xs), "x", "c", n, [], "m"))]
    padded = pd.Series(xs, dtype="float64").ffill()
    want = (padded / padded.shift(n) - 1).tolist()
    for g, w in zip(got, want):
        assert (g is None) == math.isnan(w)
        if g is not None:
            assert g == w or g == pytest.approx(w)


def test_pivot_last(rows):
    df = rows([(1, "a", 1.0, 1), (1, "a", None, 2), (2, "a", None, 3), (3, "a", 5.0, 4), (3, "b", None, 5)], "m int, s string, v double, i int")
    wide = pivot.pivot_last(df, ["m"], "s", "v", {"a": "a", "b": "b"}, ["i"])
    assert values(wide) == [(1, 1.0, None), (3, 5.0, None)]


@pytest.mark.parametrize("seed", range(3))
def test_pivot_last_like_pandas(rows, seed):
    rng = random.Random(seed)
    data = [(rng.randrange(6), rng.choice("abc"), rng.choice([None, rng.random()]), i) for i in range(60)]
    df = rows(data, "m int, s string, v double, i int")
    got = values(pivot.pivot_last(df, ["m"], "s", "v", {c: c for c in "abc"}, ["i"]))
    frame = pd.DataFrame(data, columns=["m", "s", "v", "i"])
    want = frame.pivot_table(index="m", columns="s", values="v", aggfunc="last").reindex(columns=list("abc")).reset_index()
    assert [tuple(None if isinstance(x, float) and math.isnan(x) else x for x in r) for r in want.itertuples(index=False)] == got


def test_resample_takes_the_last_known_day(rows):
    df = rows([("t", D(2020, 1, 2), 1.0), ("t", D(2020, 1, 30), 2.0), ("t", D(2020, 1, 31), None), ("t", D(2020, 2, 1), 3.0)], "s string, d date, v double")
    assert values(pivot.resample_last(df, ["s"], "d", "v", "month", ["d"])) == [("t", D(2020, 1, 1), 2.0), ("t", D(2020, 2, 1), 3.0)]


def test_spine(spark):
    months = values(calendar.spine(spark, D(1990, 1, 1), D(1991, 3, 15)))
    assert months[0] == (D(1990, 1, 1),) and months[-1] == (D(1991, 3, 1),) and len(months) == 15
    today = datetime.date.today()
    assert calendar.spine(spark).count() == (today.year - 1990) * 12 + today.month


@pytest.mark.parametrize("grain", ["day", "week", "month", "quarter", "year"])
def test_densify_equals_the_grid(rows, grain):
    starts = {"day": [0, 1, 5], "week": [0, 7, 35], "month": [0, 31, 152], "quarter": [0, 182], "year": [0, 366, 1096]}[grain]
    first = D(2024, 1, 1)
    data = [(e, first + datetime.timedelta(days=s), float(s)) for e in (1, 2, None) for s in starts[: 3 if e == 1 else 2]]
    df = rows(data, "e int, p date, v double")
    got = values(calendar.densify(df, ["e"], "p", grain))
    grid = calendar.dense_grid(df, ["e"], "p", grain).alias("g")
    same = [F.col("g.e").eqNullSafe(F.col("d.e")), F.col("g.p") == F.col("d.p")]
    assert got == values(grid.join(df.alias("d"), same, "left").select("g.e", "g.p", "v"))


def test_quarter_change_reaches_all_months(rows):
    xs = [10.0, None, None, 8.0, None, None, 9.0, None, None]
    df = features.with_quarter_change(series(rows, xs), "x", "c", [], "m")
    assert [r[2] for r in values(df)] == [None] * 3 + [-2.0] * 3 + [1.0] * 3


def test_entity_windows_stay_apart(rows):
    df = rows([("a", month(0), 1.0), ("a", month(1), 4.0), ("b", month(1), 10.0)], "e string, m date, x double")
    assert values(df.select("e", "m", features.diff("x", 1, ["e"], "m").alias("d"))) == [
        ("a", month(0), None), ("a", month(1), 3.0), ("b", month(1), None)]


def brute_asof(asks, facts):
    out = []
    for key, t, tag in asks:
        seen = [f for f in facts if key is not None and f[0] == key and t is not None and f[1] is not None and f[1] <= t]
        out.append((key, t, tag, max(seen, key=lambda f: (f[1], f[2]))[2] if seen else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [None, 1, 5, 40])
def test_asof_join_against_brute_force(rows, partitions):
    rng = random.Random(5)
    keys = ["hot"] * 20 + ["a", "b", None]
    asks = [(rng.choice(keys), rng.choice([None, *range(40)]), i) for i in range(300)]
    facts = [(rng.choice(keys + ["c"]), rng.choice([None, *range(40)]), i) for i in range(60)]
    got = joins.asof_join(
        rows(asks, "k string, t int, tag int"), rows(facts, "k string, at int, v int"), ["k"], "t", "at", ["v"], ["v"], partitions)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_asof(asks, facts)


def test_asof_join_of_one_hot_moment(spark, rows):
    """Nearly all left rows ask at one moment, long after the only right row: every partition takes it from the borders."""
    asks = spark.range(4000).select(F.lit("k").alias("k"), F.lit(9).alias("t"), F.col("id").alias("tag"))
    got = joins.asof_join(asks, rows([("k", 1, 7)], "k string, at int, v int"), ["k"], "t", "at", ["v"], partitions=12)
    assert got.groupBy("v").count().collect() == [(7, 4000)]
    assert got.count() == 4000


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_asof_join_of_two_keys_like_brute_force(rows, data):
    some = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([0.5, 2.0]), st.integers(0, 6)), min_size=1, max_size=40)
    asks = [(*x, i) for i, x in enumerate(data.draw(some))]
    facts = [(*x, i) for i, x in enumerate(data.draw(some))]
    got = joins.asof_join(
        rows(asks, "k string, e double, t int, tag int"), rows(facts, "k string, e double, at int, v int"), ["k", "e"], "t", "at", ["v"], ["v"], 4)
    flat = [((k, e) if k is not None else None, t, i) for k, e, t, i in asks], [((k, e) if k is not None else None, t, i) for k, e, t, i in facts]
    want = {tag: v for _, _, tag, v in brute_asof(*flat)}
    assert {r["tag"]: r["v"] for r in got.collect()} == want


@pytest.mark.parametrize("kind, times", [
    ("timestamp", [datetime.datetime(2020, 1, d, h, 30) for d in range(1, 4) for h in (0, 7, 8)]),
    ("date", [datetime.date(2020, 1, d) for d in range(1, 9)]),
    ("string", ["a", "b", "c", "d", "e"]),
])
def test_asof_join_takes_every_type_of_time(rows, kind, times):
    asks = [("a", t, i) for i, t in enumerate(times)]
    facts = [("a", t, i) for i, t in enumerate(times[1::2])]
    got = joins.asof_join(rows(asks, f"k string, t {kind}, tag int"), rows(facts, f"k string, at {kind}, v int"), ["k"], "t", "at", ["v"])
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_asof(asks, facts)


def test_asof_join_plan(rows):
    """Each side is scanned once, dealt once by ranges, and the only window runs over border rows."""
    asks = rows([("a", datetime.datetime(2020, 1, 1))], "k string, t timestamp")
    facts = rows([("a", datetime.datetime(2020, 1, 1), 7)], "k string, at timestamp, v int")
    joined = joins.asof_join(asks, facts, ["k"], "t", "at", ["v"])
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("rangepartitioning") == 1 + final.count("ReusedExchange")
    assert final.count("Window [") == 1 and "_step" in final


def test_lookup_defaults(rows):
    dim = rows([("a", "x", None)], "k string, p string, q string")
    got = joins.lookup(rows([("a",), ("b",)], "k string"), dim, ["k"], {"p": "unknown", "q": ""})
    assert values(got) == [("a", "x", ""), ("b", "unknown", "")]


def test_selection(rows):
    df = rows([(D(2020, 1, 1), "a"), (D(2020, 2, 1), "b"), (None, "c")], "d date, s string")
    assert values(select.between_periods(df, "d", D(2020, 1, 1), D(2020, 1, 31))) == [(D(2020, 1, 1), "a")]
    assert values(select.lookback(df, "d", 10, D(2020, 2, 5))) == [(D(2020, 2, 1), "b")]
    good, bad = select.split_valid(df, F.col("d") > D(2020, 1, 15))
    assert values(good) == [(D(2020, 2, 1), "b")] and bad.count() == 2
    assert values(select.stack([df.select("s"), df.filter("s = 'a'")])) == [("a", None), ("a", D(2020, 1, 1)), ("b", None), ("c", None)]


def test_missing_members(rows):
    df = rows([("a",), ("b",), (None,)], "s string")
    assert values(rollup.missing_members(df, "s", ["a", "z"])) == [("z",)]


def test_annual_rollup(rows):
    df = rows([(2020, 1.0), (2020, 2.0), (2020, None), (2021, 3.0)], "year int, x double")
    assert values(rollup.annual_rollup(df, "year", {"m": ("x", 1)})) == [(2020, 1.5, 3), (2021, 3.0, 1)]


def test_annual_rollup_of_values_beyond_fixed_point(rows):
    df = rows([(2020, 1.0), (2020, math.inf), (2021, 1e30), (2021, 3e30)], "year int, x double")
    assert values(rollup.annual_rollup(df, "year", {"m": ("x", 1)})) == [(2020, math.inf, 2), (2021, 2e30, 2)]


def test_audit_column_and_unify(rows):
    df = rows([("a", 1)], "s string, v int")
    got = select.with_audit(select.unify(df, {"name": F.col("s"), "double": F.col("v") * 2}), "at", F.lit(D(2024, 1, 1)))
    assert values(got) == [("a", 2, D(2024, 1, 1))]
    assert select.with_audit(df, "at").schema["at"].dataType.typeName() == "timestamp"

"""Types that widen, past states by SQL, and stored sketches."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frames import values
from macrospark.operators import sketches
from macrospark.sources.versioned import VersionedTable, widened, widens

UTC = datetime.timezone.utc


def test_lattice():
    i, l, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert widens(i, l) and widens(l, d) and widens(i, d) and not widens(l, i) and not widens(d, l) and not widens(i, s)
    assert widens(T.DateType(), T.TimestampNTZType()) and not widens(T.TimestampNTZType(), T.DateType())
    assert widens(T.DecimalType(10, 2), T.DecimalType(12, 3)) and not widens(T.DecimalType(10, 2), T.DecimalType(10, 3))
    assert widens(i, T.DecimalType(12, 2)) and not widens(l, T.DecimalType(12, 2))
    one, two = T.StructType().add("a", i).add("b", s), T.StructType().add("a", l).add("c", d)
    assert widened(one, two) == T.StructType().add("a", l).add("b", s).add("c", d) == T.StructType([widened(two, one)["a"], one["b"], two["c"]])
    with pytest.raises(ValueError):
        widened(one, T.StructType().add("a", s))


def test_promotion_and_refusal(rows, spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), ["k"])
    table.upsert(rows([(1, 1), (2, 2)], "k int, v int"))
    table.upsert(rows([(2, 1 << 40)], "k int, v long"))
    with pytest.raises(ValueError, match="narrow"):
        table.upsert(rows([(3, 3)], "k int, v int"))
    assert table.last_version() == 1
    table.upsert(rows([(3, 0.5, "x")], "k int, v double, w string"))
    assert values(table.read()) == [(1, 1.0, None), (2, float(1 << 40), None), (3, 0.5, "x")]
    assert values(table.read(0)) == [(1, 1), (2, 2)]
    table.compact()
    assert values(table.read()) == [(1, 1.0, None), (2, float(1 << 40), None), (3, 0.5, "x")]


def test_past_states_by_sql(rows, spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), ["k"], order=["o"])
    day = lambda n: datetime.datetime(2024, 1, n, tzinfo=UTC)
    table.upsert(rows([(1, 5, "a"), (2, 5, "b"), (None, 1, "n")], "k int, o int, v string"), day(1))
    table.upsert(rows([(1, 4, "late"), (2, 6, "c"), (None, 1, "n")], "k int, o int, v string"), day(2))
    table.overwrite(rows([(9, 1, "z")], "k int, o int, v string"), day(3))
    table.upsert(rows([(1, 1, "new")], "k int, o int, v string"), day(4))
    table.register("t")
    for version in range(4):
        assert values(spark.sql(f"SELECT * FROM t_at({version})")) == values(table.read(version))
        assert values(spark.sql(f"SELECT * FROM t_asof(TIMESTAMP '2024-01-0{version + 1} 12:00:00')")) == values(table.read(at=day(version + 1) + datetime.timedelta(hours=12)))


def test_sketches_roll_up(spark):
    df = spark.range(30_000).select((F.col("id") % 24).alias("hour"), (F.col("id") % 7_000).alias("user"))
    hours = sketches.sketched(df, ["hour"], "user")
    for part in (6, 24):
        days = sketches.distinct_keys(sketches.rolled_up(hours, [F.floor(F.col("hour") / part).alias("part")]))
        exact = dict(df.groupBy(F.floor(F.col("hour") / part)).agg(F.count_distinct("user")).collect())
        for r in days.collect():
            assert abs(r["distinct_keys"] - exact[r["part"]]) <= 5 * sketches.STANDARD_ERROR * exact[r["part"]] and r["rows"] == 30_000 * part // 24
    nothing = sketches.distinct_keys(sketches.sketched(df.limit(0), ["hour"], "user"))
    assert nothing.count() == 0

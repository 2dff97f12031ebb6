"""Data-quality checks, each one tidy row ``(check, target, observed, threshold, status)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.operators.rollup import missing_members
from macrospark.sources.inline import inline_table

# Freshness limits in days, refresh gate, and least share of known values.
WARN_AFTER_DAYS = 1.0
ERROR_AFTER_DAYS = 3.0
MIN_REFRESHED_KEYS = 5
REFRESH_WINDOW = "interval 2 hours"
MIN_NON_NULL_RATIO = 0.8


RESULT = "check string, target string, observed double, threshold double, status string"


def _result(check: str, target: str, observed: Column, threshold: float, status: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        F.lit(target).alias("target"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        status.alias("status"),
    ]


def _pass_fail(ok: Column) -> Column:
    return F.when(ok, "pass").otherwise("fail")


def _days_between(start: Column, end: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        # wall-clock times: their difference must not depend on the session's time zone
        gap = end - start
        parts = {"DAY": 1, "HOUR": 24, "MINUTE": 1440, "SECOND": 86400}
        return sum((F.extract(F.lit(u), gap).cast("double") / n for u, n in parts.items()), F.lit(0.0))
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 86400e6


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counts of all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(*_result("not_null", c, F.col(c), 0, _pass_fail(F.col(c) == 0))) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once; nulls are not compared."""
    known = df.select(*keys).dropna("any")
    repeated = known.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("n"))
    return repeated.select(*_result("unique", ",".join(keys), F.col("n"), 0, _pass_fail(F.col("n") == 0)))


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Number of known values outside a list."""
    stray = df.agg(F.count_if(~F.col(column).isin(*values)).alias("n"))
    return stray.select(*_result("accepted_values", column, F.col("n"), 0, _pass_fail(F.col("n") == 0)))


def check_freshness(
    df: DataFrame,
    at: str,
    as_of: Column,
    warn_days: float = WARN_AFTER_DAYS,
    error_days: float = ERROR_AFTER_DAYS,
) -> DataFrame:
    """Age of the newest load in days; an empty table is an error."""
    kind = df.schema[at].dataType
    age = df.agg(_days_between(F.max(at), as_of.cast(kind), kind).alias("age"))
    status = (
        F.when(F.col("age").isNull() | (F.col("age") > error_days), "error")
        .when(F.col("age") > warn_days, "warn")
        .otherwise("ok")
    )
    return age.select(*_result("freshness", at, F.col("age"), error_days, status))


def check_refreshed(df: DataFrame, key: str, at: str, as_of: Column, minimum: int = MIN_REFRESHED_KEYS) -> DataFrame:
    """Whether enough distinct keys were loaded in the window before ``as_of``."""
    recent = df.filter(F.col(at) >= as_of - F.expr(REFRESH_WINDOW)).agg(F.count_distinct(F.col(key)).alias("n"))
    return recent.select(*_result("refreshed_keys", key, F.col("n"), minimum, _pass_fail(F.col("n") >= minimum)))


def check_non_empty(df: DataFrame, name: str) -> DataFrame:
    found = df.select(F.lit(1).alias("_one")).limit(1).agg(F.count("*").alias("n"))
    return found.select(*_result("non_empty", name, F.col("n"), 1, _pass_fail(F.col("n") > 0)))


def check_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required columns; looks at the schema only."""
    rows = [("required_column", c, float(c in df.columns), 1.0, "pass" if c in df.columns else "fail") for c in required]
    return inline_table(df.sparkSession, rows, RESULT)


def check_non_null_ratio(df: DataFrame, column: str, least: float = MIN_NON_NULL_RATIO) -> DataFrame:
    """Share of known values, which must exceed ``least``; none at all fails."""
    ratio = df.agg((F.count(column) / F.nullif(F.count("*"), F.lit(0))).alias("r"))
    return ratio.select(*_result("non_null_ratio", column, F.col("r"), least, _pass_fail(F.col("r") > least)))


def check_members(df: DataFrame, column: str, required: Sequence[str]) -> DataFrame:
    absent = missing_members(df, column, required).agg(F.count("*").alias("n"))
    return absent.select(*_result("required_members", column, F.col("n"), 0, _pass_fail(F.col("n") == 0)))


def check_no_future(df: DataFrame, column: str, as_of: Column) -> DataFrame:
    """Days by which the latest date lies beyond ``as_of``."""
    latest = df.agg(F.max(F.col(column).cast("date")).alias("d"))
    ahead = F.greatest(F.date_diff("d", as_of.cast("date")), F.lit(0))
    return latest.select(*_result("no_future_dates", column, ahead, 0, _pass_fail(F.coalesce(ahead == 0, F.lit(True)))))


def check_keyed(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``check_not_null`` of the columns and ``check_unique`` of the keys, in one pass over the rows."""
    nulls = {c: f"_null{i}" for i, c in enumerate(columns)}
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items()])
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    counts = groups.agg(F.count_if((F.col("_n") > 1) & whole).alias("_n"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in nulls.values()])
    rows = [F.struct(*_result("not_null", c, F.col(n), 0, _pass_fail(F.col(n) == 0))) for c, n in nulls.items()]
    rows.append(F.struct(*_result("unique", ",".join(keys), F.col("_n"), 0, _pass_fail(F.col("_n") == 0))))
    return counts.select(F.inline(F.array(*rows)))


class Observed:
    """Checks whose figures the job that writes the rows collects on its way: nothing is read again.

    Write ``rows``; then ``report()`` gives the rows of ``check_non_empty``,
    ``check_not_null``, ``check_accepted_values``, ``check_freshness`` and
    ``check_refreshed``, and ``earliest()`` the first load time. Distinct keys
    are counted by a sketch, which is exact for as few as the gate asks for.
    """

    def __init__(
        self,
        df: DataFrame,
        name: str,
        not_null: Sequence[str] = (),
        accepted: Mapping[str, Sequence] | None = None,
        key: str | None = None,
        at: str | None = None,
        as_of: Column | None = None,
    ):
        self._spark, self._found, self._at, self._key = df.sparkSession, Observation(), at, key
        self._name, self._not_null, self._accepted = name, list(not_null), dict(accepted or {})
        figures = [F.count(F.lit(1)).alias("rows")]
        figures += [F.count_if(F.col(c).isNull()).alias(f"null{i}") for i, c in enumerate(self._not_null)]
        figures += [F.count_if(~F.col(c).isin(*v)).alias(f"stray{i}") for i, (c, v) in enumerate(self._accepted.items())]
        if at is not None:
            moment = F.current_timestamp() if as_of is None else as_of
            kind = df.schema[at].dataType
            figures += [F.min(at).alias("earliest"), _days_between(F.max(at), moment.cast(kind), kind).alias("age")]
            if key is not None:
                recent = F.when(F.col(at) >= moment - F.expr(REFRESH_WINDOW), F.col(key))
                figures.append(F.approx_count_distinct(recent, 0.01).alias("keys"))
        self.rows = df.observe(self._found, *figures)

    def earliest(self):
        return self._found.get.get("earliest")

    def report(self) -> DataFrame:
        got = self._found.get

        def row(check: str, target: str, observed, threshold: float, ok: bool) -> tuple:
            return check, target, None if observed is None else float(observed), float(threshold), "pass" if ok else "fail"

        rows = [row("non_empty", self._name, min(got["rows"], 1), 1, got["rows"] > 0)]
        rows += [row("not_null", c, got[f"null{i}"], 0, got[f"null{i}"] == 0) for i, c in enumerate(self._not_null)]
        rows += [row("accepted_values", c, got[f"stray{i}"], 0, got[f"stray{i}"] == 0) for i, c in enumerate(self._accepted)]
        if self._at is not None:
            age = got["age"]
            status = "error" if age is None or age > ERROR_AFTER_DAYS else "warn" if age > WARN_AFTER_DAYS else "ok"
            if self._key is not None:
                rows.append(row("refreshed_keys", self._key, got["keys"], MIN_REFRESHED_KEYS, got["keys"] >= MIN_REFRESHED_KEYS))
            rows.append(("freshness", self._at, None if age is None else float(age), ERROR_AFTER_DAYS, status))
        return inline_table(self._spark, rows, RESULT)


def passed(report: DataFrame) -> bool:
    """Whether no check failed; the caller decides whether to raise."""
    return report.filter(F.col("status").isin("fail", "error")).isEmpty()

"""Table settings and the refresh of a source from landed documents to the mart."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark.operators import quality
from macrospark.operators.dedupe import dedupe_latest
from macrospark.plans import marts, staging
from macrospark.sources import sinks
from macrospark.sources.versioned import VersionedTable


@dataclass(frozen=True)
class TableSpec:
    """Source table, folder, merge keys, partition columns, and what makes a key's row the newest."""

    source: str
    path: str
    keys: Sequence[str]
    partition_by: Sequence[str] = ()
    order: Sequence[str] = ()


# The configured tables.
TABLES = {
    "fred_observations": TableSpec(
        "raw.fred_observations", "fred/observations", ("series_id", "observation_date"), ("category",), ("ingested_at",)
    ),
    "bea_nipa_observations": TableSpec(
        "raw.bea_nipa_observations", "bea/nipa_observations",
        ("table_key", "series_name", "period_date"), ("frequency",), ("ingested_at",),
    ),
    "market_prices": TableSpec(
        "raw.market_prices", "market/prices", ("ticker", "trade_date"), ("asset_class",)
    ),
    "macro_indicators_monthly": TableSpec(
        "marts.fct_macro_indicators_monthly", "marts/macro_indicators_monthly", ("observation_month",), ("year",)
    ),
    "bls_observations": TableSpec(
        "raw.bls_observations", "bls/observations", ("series_id", "observation_date"), ("category",), ("ingested_at",)
    ),
}


def open_table(spark: SparkSession, spec: TableSpec, root: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/{spec.path}", spec.keys, spec.partition_by, spec.order)


def run_table(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    root: str,
    mode: str = "merge",
    at: datetime | None = None,
    tie: Sequence[str] | None = None,
) -> int:
    """Newest row per key of the source, merged into or replacing the versioned table."""
    newest = dedupe_latest(source, spec.keys, spec.order, tie)
    table = open_table(spark, spec, root)
    if mode == "merge":
        return table.upsert(newest, at)
    if mode == "overwrite":
        return table.overwrite(newest, at)
    raise ValueError(f"mode must be 'merge' or 'overwrite', not {mode!r}")


class GateClosed(Exception):
    """Loaded rows did not pass the checks ahead of the merge; nothing was merged."""


def refresh_source(
    spark: SparkSession,
    rows: DataFrame,
    spec: TableSpec,
    root: str,
    stage: Callable[[DataFrame], DataFrame] = staging.stage_fred,
    as_of: datetime | None = None,
    since: datetime | None = None,
    full: bool = False,
    gate: Sequence[str] = (),
    tie: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load bronze rows, merge them, and return ``(staged, report)``.

    The rows are written to the raw log first and read back from there, so
    every later step works on the same stored rows. Merged is what was loaded
    from ``since`` on, by default from the earliest load time among the new
    rows; ``full`` merges the whole log. A row older than the stored one does
    not replace it.

    The job that writes the raw log also collects the figures of the first
    checks and the earliest load time, so the new rows are computed once and
    the stored ones read once, by the merge. The checks named in ``gate`` (``refreshed_keys``, ``freshness``) must pass
    before the merge; if one fails, ``GateClosed`` is raised. They judge the
    rows of this load.
    """
    moment = F.current_timestamp() if as_of is None else F.lit(as_of)
    observed = quality.Observed(rows, spec.source, list(spec.keys), key=spec.keys[0], at="ingested_at", as_of=moment)
    raw = f"{root}/raw_tables/{spec.source}"
    sinks.load_raw(observed.rows, raw)
    report = observed.report()
    closed = [r.check for r in report.collect() if r.check in gate and r.status not in ("pass", "ok", "warn")]
    if closed:
        raise GateClosed(f"{spec.source}: {', '.join(closed)}")
    loaded = spark.read.schema(rows.schema).parquet(raw)
    since = observed.earliest() if since is None and not full else since
    if since is not None:
        loaded = loaded.filter(F.col("ingested_at") >= F.lit(since))
    run_table(spark, spec, loaded, root, at=as_of, tie=tie)
    staged = stage(open_table(spark, spec, root).read())
    return staged, report.unionByName(quality.check_keyed(staged, spec.keys, [*spec.keys, "is_missing"]))


def refresh_mart(
    spark: SparkSession,
    staged: DataFrame,
    months: DataFrame,
    root: str,
    at: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Build the monthly mart from staged series, publish it, sort its files, and check what was published."""
    spec = TABLES["macro_indicators_monthly"]
    run_table(spark, spec, marts.monthly_mart(staged, months), root, "overwrite", at)
    table = open_table(spark, spec, root)
    table.compact(at=at)
    published = table.read()
    report = quality.check_not_null(published, list(spec.keys)).unionByName(quality.check_unique(published, spec.keys))
    return published, report


def refresh_all(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    mode: str = "merge",
    compact: bool = False,
    at: datetime | None = None,
    ties: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, int]:
    """Run every named table, and sort its files if asked; returns the versions.

    ``ties`` names, per table, the columns that choose between rows of one key and vintage (all, if not given).
    """
    versions = {}
    for name, source in sources.items():
        versions[name] = run_table(spark, TABLES[name], source, root, mode, at, (ties or {}).get(name))
        if compact:
            versions[name] = open_table(spark, TABLES[name], root).compact(at=at)
    return versions

"""Upsert and history over a change log.

A log row is a table row plus ``_version`` and ``_committed_at``; a version has
one row per key. A key's state is its newest row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrospark.operators.dedupe import any_null, dedupe_latest, null_spread

BOOKKEEPING = ("_version", "_committed_at")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Target rows whose key the source does not have, plus all source rows.

    The source has one row per key. A null key equals nothing, so such target
    rows stay and such source rows are added, unless ``null_safe``.
    """
    both = target.withColumn("_side", F.lit(0)).unionByName(source.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    apart = F.lit(0).cast("bigint") if null_safe else _apart(keys)
    # Each side is read once, and one shuffle brings a key's rows together.
    ranked = Window.partitionBy(*keys, "_apart").orderBy(F.desc("_side"))
    found = both.withColumn("_apart", apart).withColumn("_newest", F.rank().over(ranked))
    return found.filter("_newest = 1").drop("_side", "_apart", "_newest")


def _apart(keys: Sequence[str]) -> Column:
    """Zero, or for rows with a null key a number of their own: they equal nothing and share no task."""
    return F.when(any_null(keys), F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("bigint"))


def resolve(log: DataFrame, keys: Sequence[str], visible: Column | None = None, order: Sequence[str] = ()) -> DataFrame:
    """State of the table after the visible log rows, in one scan; rows with a null key are all kept.

    Of a key's rows the greatest by ``order`` stays, and of equal ones the newest version.
    """
    seen = log if visible is None else log.filter(visible)
    spread = seen.withColumn("_apart", _apart(keys))
    return dedupe_latest(spread, [*keys, "_apart"], [*order, "_version"]).drop("_apart", *BOOKKEEPING)


def as_of_version(log: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    return resolve(log, keys, F.col("_version") <= version)


def as_of_timestamp(log: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    return resolve(log, keys, F.col("_committed_at") <= at)


def history(log: DataFrame, keys: Sequence[str], whole: Sequence[int] = ()) -> DataFrame:
    """Rows inserted, updated and written in total per version.

    A row is an insert in the version where its key first appears, counted
    anew after each version that replaced the whole table; those versions
    neither insert nor update. Found here, so that a commit need not look up
    which keys it meets. Only key columns are read.
    """
    version = F.col("_version")
    earlier = F.filter(F.array(*[F.lit(w) for w in whole]), lambda w: w <= version)
    rows = log.select(*keys, "_version", (F.size(earlier) if whole else F.lit(0)).alias("_since"))
    fresh = rows.groupBy("_since", *keys, _apart(keys).alias("_apart")).agg(F.min("_version").alias("_version"))
    inserted = fresh.groupBy("_version").agg(F.count("*").alias("inserted"))
    counted = rows.groupBy("_version").agg(F.count("*").alias("total")).join(inserted, "_version", "left")
    merged = ~version.isin(*whole) if whole else F.lit(True)
    new = F.when(merged, F.coalesce("inserted", F.lit(0))).otherwise(0)
    known = F.when(merged, F.col("total") - new).otherwise(0)
    return counted.select("_version", new.alias("inserted"), known.alias("updated"), "total")


def state_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed between two states."""
    values = [c for c in new.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, null_spread(keys, df.columns).alias("_spread"), F.struct(*values).alias(name))

    both = side(old, "_old").join(side(new, "_new"), [*keys, "_spread"], "full")
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    return both.select(*keys, change.alias("change")).filter("change is not null")


def log_diff(log: DataFrame, keys: Sequence[str], old: int, new: int) -> DataFrame:
    """``state_diff`` of two versions of one log, in a single pass and shuffle."""
    version = F.col("_version")
    seen = log.filter(version <= new).withColumn("_apart", _apart(keys))
    values = F.struct(*[c for c in log.columns if c not in (*keys, *BOOKKEEPING)])
    states = seen.groupBy(*keys, "_apart").agg(
        F.min(version).alias("_first"),
        F.max_by(values, F.when(version <= old, version)).alias("_old"),
        F.max_by(values, version).alias("_new"),
    )
    change = F.when(F.col("_first") > old, "added").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return states.select(*keys, change.alias("change")).filter("change is not null")


def state_counts(log: DataFrame, keys: Sequence[str], versions: Sequence[int]) -> DataFrame:
    """Number of rows of the table after each of the versions of one log; reads key columns only."""
    rows = log.select(*keys, "_version")
    begun = rows.groupBy(*keys, _apart(keys).alias("_apart")).agg(F.min("_version").alias("_first"))
    counts = begun.agg(*[F.count_if(F.col("_first") <= v).alias(f"v{v}") for v in versions])
    listed = [F.struct(F.lit(v).alias("version"), F.col(f"v{v}").alias("row_count")) for v in versions]
    return counts.select(F.inline(F.array(*listed)))


def retain(log: DataFrame, keys: Sequence[str], cutoff: Column) -> DataFrame:
    """Log rows still needed when history before ``cutoff`` may be forgotten.

    That is every row since then, and of the older ones the newest per key.
    """
    old = log.filter((F.col("_committed_at") < cutoff) & ~any_null(keys))
    kept = log.filter((F.col("_committed_at") >= cutoff) | any_null(keys))
    return dedupe_latest(old, keys, ["_version"]).unionByName(kept)

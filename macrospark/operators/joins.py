"""Metadata lookups, the outer merge and the point-in-time join."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.operators.dedupe import any_null


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], defaults: Mapping[str, str]) -> DataFrame:
    """Left join to a dimension; rows without an entry get the defaults.

    No broadcast hint: Spark broadcasts by the size it knows, which it does
    know for the inline dimensions.
    """
    joined = df.join(dim, list(on), "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join with the keys coalesced."""
    return left.join(right, list(on), "full")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Every left row with the newest right values at or before its time.

    Both sides are stacked and dealt by ranges of (key, time), so a hot key, or
    a hot moment, is spread over as many partitions as its rows fill; no pairs
    are formed. Each sorted partition carries the last right row forward, and
    passes on one border row: its last key and that key's last right row. Left
    rows ahead of the first right row of a partition's first key get theirs
    from the border rows, of which there are as many as partitions.

    Rows and border rows must come from the same ranges. Spark reuses the
    exchange for both; should it not, each partition finds that its border row
    has another first row, and the query fails.

    Null keys and times match nothing. Of right rows that agree in time and
    ``tie`` one is taken, by its values. ``partitions`` defaults to the
    session's shuffle partitions.
    """
    spark = left.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = left.schema[left_time].dataType
    keys, ties = [f"_k{i}" for i in range(len(by))], [f"_tie{i}" for i in range(len(tie))]
    left_row, right_row = F.struct(*left.columns), F.struct(*values)
    left_type, right_type = left.select(left_row.alias("r")).schema["r"].dataType, right.select(right_row.alias("r")).schema["r"].dataType
    named = [F.col(c).alias(k) for c, k in zip(by, keys)]
    asks = left.select(
        *named, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.monotonically_increasing_id().alias("_apart"),
        left_row.alias("_left"), F.lit(None).cast(right_type).alias("_right"),
    )
    facts = right.filter(~any_null([*by, right_time])).select(
        *named, F.col(right_time).cast(kind).alias("_t"), F.lit(0).alias("_side"), F.xxhash64(*values).alias("_apart"),
        F.lit(None).cast(left_type).alias("_left"), right_row.alias("_right"), *[F.col(c).alias(t) for c, t in zip(tie, ties)],
    )
    order = [*keys, "_t", "_side", *ties, "_apart"]
    both = asks.unionByName(facts, allowMissingColumns=True).withColumn("_row", F.xxhash64(*order))
    dealt = both.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.select(*keys, "_t", "_side", "_row", "_left", "_right")
    head = T.StructType([dealt.schema[k] for k in keys])
    ends = [T.StructField(f"_end{i}", f.dataType) for i, f in enumerate(head.fields)]
    schema = T.StructType(
        [T.StructField("_first", T.LongType()), T.StructField("_kind", T.IntegerType()), T.StructField("_part", T.IntegerType()),
         *head.fields, *ends, T.StructField("_left", left_type), T.StructField("_right", right_type)]
    )
    width = len(keys)

    def last_before(mask: np.ndarray) -> np.ndarray:
        """For each row the last row up to it where the mask holds; -1 if there is none."""
        return np.maximum.accumulate(np.where(mask, np.arange(len(mask)), -1))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Left rows (kind 1, or 2 if what stood before the partition is still to come), and one border row (kind 0)."""
        part = TaskContext.get().partitionId()  # ranges are numbered in their order
        first = first_key = key = held = names = None  # held: the last right row of `key` so far
        opening = True  # still in the partition's first key, and no right row of it has come
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(i).type for i in range(width)]
            names = names or pa.schema(
                [("_first", pa.int64()), ("_kind", pa.int32()), ("_part", pa.int32()), *((f"_k{i}", k) for i, k in enumerate(kinds)),
                 *((f"_end{i}", k) for i, k in enumerate(kinds)),
                 ("_left", batch.schema.field("_left").type), ("_right", batch.schema.field("_right").type)]
            )
            columns = [batch.column(i) for i in range(width)]
            rows = batch.num_rows
            changed = np.zeros(rows, bool)
            known = batch.column("_t").is_valid().to_numpy(zero_copy_only=False).copy()
            for c in columns:
                known &= c.is_valid().to_numpy(zero_copy_only=False)
                same = pc.fill_null(pc.equal(c[1:], c[:-1]), False)
                if pa.types.is_floating(c.type):  # keys that are no number are one key
                    same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(c[1:]), pc.is_nan(c[:-1])), False))
                changed[1:] |= ~same.to_numpy(zero_copy_only=False)
            here = [c[0] for c in columns]
            if key is None:
                first, first_key, key = batch.column("_row")[0].as_py(), here, here
            elif any(a != b and not (a.as_py() != a.as_py() and b.as_py() != b.as_py()) for a, b in zip(here, key)) or not all(k.is_valid for k in key):
                changed[0] = True
            right, side = batch.column("_right"), batch.column("_side").to_numpy(zero_copy_only=False)
            is_fact = side == 0
            fact, turn = last_before(is_fact), last_before(changed)
            own = (fact >= 0) & (fact >= turn)  # a right row of the same key, in this batch
            earlier = (turn < 0) & ~own  # the key of the batch before, so what was held counts
            store = pa.concat_arrays([held, right]) if held is not None else right
            shift = len(store) - rows
            at = np.where(own, fact + shift, np.where(earlier & (shift > 0), 0, -1))
            open_rows = earlier & opening & (shift == 0)
            asking = np.flatnonzero(~is_fact)
            taken = at[asking]
            hit = store.take(pa.array(taken, pa.int64(), mask=(taken < 0) | ~known[asking]))
            state = np.where(open_rows[asking] & known[asking], 2, 1).astype(np.int32)
            size = len(asking)
            picked = pa.array(asking)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, first, np.int64)), pa.array(state), pa.array(np.full(size, part, np.int32)),
                 *(pa.nulls(size, k) for k in kinds + kinds),
                 batch.column("_left").take(picked), hit],
                schema=names,
            )
            opening = opening and not changed.any() and not is_fact.any()
            held = right.slice(int(fact[-1]), 1) if own[-1] else held if earlier[-1] else None
            key = [c[rows - 1] for c in columns]
        if key is not None:
            one = [pa.array([k.as_py()], k.type) for k in first_key], [pa.array([k.as_py()], k.type) for k in key]
            yield pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()), pa.array([0], pa.int32()), pa.array([part], pa.int32()), *one[0], *one[1],
                 pa.nulls(1, names.field("_left").type), held if held is not None else pa.nulls(1, names.field("_right").type)],
                schema=names,
            )

    carried = dealt.mapInArrow(carry, schema)
    # What each partition's first key brings from the partitions before: two events for each border row.
    def event(step: int, names: Sequence[str], end: Column) -> Column:
        return F.struct(F.lit(step).alias("_step"), *[F.col(c).alias(k) for c, k in zip(names, keys)], end.alias("_end"))

    need, give = event(0, keys, F.lit(None).cast(right_type)), event(1, [f.name for f in ends], F.col("_right"))
    events = carried.filter("_kind = 0").select("_first", "_part", F.explode(F.array(need, give)).alias("_event")).select("_first", "_part", "_event.*")
    steps = Window.partitionBy(*keys).orderBy("_part", "_step").rowsBetween(Window.unboundedPreceding, -1)
    before = events.withColumn("_before", F.last("_end", ignorenulls=True).over(steps)).filter("_step = 0")
    before = before.select("_first", F.lit(True).alias("_met"), "_before")
    joined = carried.filter("_kind > 0").join(F.broadcast(before), "_first", "left")  # a row per partition
    met = F.when(F.col("_met").isNull(), F.raise_error(F.lit("the ranges were dealt twice; leave spark.sql.exchange.reuse on")))
    hit = F.when(F.col("_kind") == 2, F.coalesce(met.cast(right_type), F.col("_before"))).otherwise(F.col("_right"))
    return joined.select("_left.*", *[hit[v].alias(v) for v in values])

"""Weighted rendezvous hashing: rows to shards by a stable key. Built-in expressions only.

Each shard gets the score `-ln(u) / weight`, where `u` is a uniform number made from the key and
the shard's number; the lowest score wins. A new shard only adds one more score, so it takes rows
into itself and moves none between the others; a row's shard depends on nothing but its key and
the weights.

Defined cases: a null key counts as the empty key; equal keys meet in one shard; an empty table
stays empty; other columns pass through, and a new column whose name is taken gets `_` appended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from macrospark.llm.common import free_name, text_of

#: Sub-buckets of a shard in which slots are numbered; each is one sort, so none is large.
SLOT_BUCKETS = 4096


def _key(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def _score(key: Column, shard: int, weight: float) -> Column:
    mantissa = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    uniform = (mantissa.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
    return F.struct((-F.ln(uniform) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard"))


def shard_of(key: str, weights: Sequence[float]) -> Column:
    """The shard of a key column among `len(weights)` shards; the lower number wins a tie."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    k = _key(key)
    return F.array_min(F.array(*[_score(k, s, w) for s, w in enumerate(weights)]))["shard"]


def with_shard(df: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """Add each row's shard. No shuffle: the shard is a function of the key."""
    return df.withColumn(free_name(df, name), shard_of(key, weights))


def slots(df: DataFrame, shard: str, key: str, columns: Sequence[str], name: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without a gap; returns `columns` and the slot.

    A shard is numbered in hash buckets of its keys: bucket sizes are summed up (at most
    `SLOT_BUCKETS` rows per shard), and each bucket counts on from its sum. Rows that agree in
    all of `columns` are counted before the shuffle and spread out after it, so a repeated row
    makes no bucket heavy.
    """
    bucket = F.pmod(F.xxhash64(_key(key), *[c for c in columns if c != key]), F.lit(SLOT_BUCKETS)).cast("int")
    several = df.groupBy(*columns, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    ends = several.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_rows"))
    before = F.sum("_rows").over(W.partitionBy(shard).orderBy("_bucket")) - F.col("_rows")
    offsets = ends.select(F.col(shard).alias("_shard"), F.col("_bucket").alias("_b"), before.alias("_before"))
    placed = several.join(
        F.broadcast(offsets),  # shards x SLOT_BUCKETS rows at most
        (F.col(shard) == F.col("_shard")) & (F.col("_bucket") == F.col("_b")),
    )
    order = W.partitionBy(shard, "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in (key, *columns)])
    first = F.col("_before") + F.sum("_n").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    return placed.withColumn("_first", first).select(
        *columns, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias(name)
    )


def digest_columns(docs: DataFrame, shards: int = 16, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: size, checksum, law, shard, slot, and its shard if there were one more."""
    placed = docs.select(
        F.col(key),
        (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, [1.0] * shards).alias("shard"),
        shard_of(key, [1.0] * (shards + 1)).alias("grown_shard"),
    )
    columns = [key, "size", "text_crc32", "law", "shard", "grown_shard"]
    return slots(placed, "shard", key, columns)

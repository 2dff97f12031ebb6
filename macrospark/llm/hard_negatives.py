"""Hard negatives: for each anchor and positive, other-label rows whose score is a share of the positive's.

The scan is vertical (BOND). Rows are stored in blocks of at most `BLOCK`, one array per dimension,
with each dimension's least and largest value. An anchor reads the dimensions in the order of its
own magnitudes, largest first, `STEP` at a time, and adds up the scores of all rows that are still
candidates. What the dimensions not yet read can add lies between two sums over the block's least
and largest values, so every candidate's score has a lower and an upper bound. After each step the
bitmap of candidates loses the rows that cannot be wanted any more:

* for positives (rows of the anchor's label): those whose upper bound is below `positives` lower bounds;
* for negatives: those that can lie in no positive's window of scores, or that in every window they
  can lie in have `negatives` rows above them that surely lie in it.

What is left has its exact score once all dimensions are read. Scores are whole numbers: they are
added as floating-point numbers where these are exact (below 2**53), as Python's integers otherwise.

Every row meets every anchor, in blocks: anchors are packed into chunks of `CHUNK`, and each block
of rows is joined to each chunk by the chunk's number and a salt over the blocks, so a task holds
one block and one chunk at a time, whatever the size of either table. A task merges the best rows
over its blocks; only they are shuffled. Nothing but counts comes to the driver.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part;
of several rows with one id the one with the least label, then vector, counts; an anchor meets rows
with as many dimensions as it has; a positive whose score is negative has no negatives (its window
is empty), one with score 0 those of score 0; ties go to the smaller id; an empty table gives an
empty result; extra columns are not read. Components or scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from macrospark.llm.common import written

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
SCALE = 256
BLOCK, CHUNK, STEP = 8192, 1024, 8
_BLOCKS_PER_CELL = 4

_PACKED = "n long, dims int, ids binary, labels binary, vectors binary, near array<array<long>>"
_ARROW = pa.schema(
    [("n", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()),
     ("near", pa.list_(pa.list_(pa.int64())))]
)
_KEYS = ["anchor", "positive", "positive_score"]
_BEST = "anchor long, positive long, positive_score long, other long, score long"
_BEST_ARROW = pa.schema([(name, pa.int64()) for name in [*_KEYS, "other", "score"]])

Pairs = list[tuple[int, int]]  # (score, id)


def whole_rows(rows: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """(id, label, v): the rows that take part, one for each id, with whole-number components."""
    x = F.col(vector)
    wide = lambda c: c.cast("double") * F.lit(float(scale))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    good = rows.where(F.col(key).isNotNull() & label.isNotNull() & x.isNotNull()).where(~odd)
    whole = F.transform(
        x, lambda c: F.when(F.abs(wide(c)) < float(1 << 62), F.floor(wide(c))).otherwise(F.raise_error(F.lit("a component is beyond 64 bits")))
    )
    least = F.min(F.struct(label.cast("long").alias("label"), whole.alias("v"))).alias("r")
    return good.groupBy(F.col(key).cast("long").alias("id")).agg(least).select("id", "r.label", "r.v")


def _packed(rows: DataFrame, limit: int) -> DataFrame:
    """Rows (id, label, v, near) in blocks of equal dimensions, stored dimension by dimension in as few bytes as fit."""

    def block(dims: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, labels, vectors = (np.concatenate([p[i] for p in parts]) for i in range(3))
        near = [x for p in parts for x in p[3]]
        largest = int(np.abs(vectors).max()) if vectors.size else 0
        kind = np.int16 if largest < 1 << 15 else np.int32 if largest < 1 << 31 else np.int64
        values = [len(ids), dims, ids.tobytes(), labels.tobytes(), np.ascontiguousarray(vectors.T.astype(kind)).tobytes(), near]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _ARROW)], schema=_ARROW)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            lists = batch.column(2)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            begins = np.cumsum(lengths) - lengths
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for dims in np.unique(lengths).tolist():
                which = np.flatnonzero(lengths == dims)
                for first in range(0, len(which), limit):
                    some = which[first : first + limit]
                    if sizes.get(dims, 0) + len(some) > limit:
                        yield block(dims, held.pop(dims))
                        sizes[dims] = 0
                    vectors = flat[begins[some][:, None] + np.arange(dims)].reshape(len(some), dims)
                    held.setdefault(dims, []).append((ids[some], labels[some], vectors, batch.column(3).take(pa.array(some)).to_pylist()))
                    sizes[dims] = sizes.get(dims, 0) + len(some)
        for dims, parts in held.items():
            yield block(dims, parts)

    return rows.select("id", "label", "v", "near").mapInArrow(pack, _PACKED)


class Block:
    """Rows or anchors, unpacked: `vectors[d]` has dimension d of all of them."""

    def __init__(self, row: dict, prefix: str = ""):
        n, dims, data = row[f"{prefix}n"], row[f"{prefix}dims"], row[f"{prefix}vectors"]
        kind = {2: np.int16, 4: np.int32}.get(len(data) // max(n * dims, 1), np.int64)
        self.ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
        self.labels = np.frombuffer(row[f"{prefix}labels"], np.int64)
        self.vectors = np.frombuffer(data, kind).reshape(dims, n).astype(np.int64)

    def largest(self) -> int:
        return int(np.abs(self.vectors).max()) if self.vectors.size else 0


class Scan:
    """One block of rows, read dimension by dimension."""

    def __init__(self, block: Block, reach: int):
        """`reach` is the largest magnitude in any anchor."""
        dims, n = block.vectors.shape
        self.kind = np.float64 if dims * block.largest() * reach < 1 << 53 else object
        self.ids, self.labels = block.ids, block.labels
        self.vectors = block.vectors.astype(self.kind)
        self.low, self.high = self.vectors.min(axis=1), self.vectors.max(axis=1)

    def scores(self, anchor: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """The rows that stay candidates to the end, and their exact scores.

        `keep(lower, upper)` says which of the rows with these bounds are still wanted.
        """
        order = np.argsort(-np.abs(anchor.astype(float)), kind="stable")
        q = anchor.astype(self.kind)[order]
        a, b = q * self.low[order], q * self.high[order]
        # What the dimensions from each step on can add, at least and at most.
        rest_low = np.append(np.cumsum(np.minimum(a, b)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(np.maximum(a, b)[::-1])[::-1], 0)
        partial = np.zeros(len(rows), self.kind)
        for first in range(0, len(order), STEP):
            end = min(first + STEP, len(order))
            seen = self.vectors[order[first:end]]
            partial = partial + q[first:end] @ (seen if len(rows) == seen.shape[1] else seen[:, rows])
            wanted = keep(partial + rest_low[end], partial + rest_high[end])
            rows, partial = rows[wanted], partial[wanted]
            if not len(rows):
                break
        return rows, partial


def _kth(values: np.ndarray, k: int):
    """The k-th largest value, or None if there are fewer."""
    if len(values) < k:
        return None
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> Pairs:
    """The first k by score, largest first, then id."""
    limit = _kth(scores, k)
    if limit is not None:
        ids, scores = ids[scores >= limit], scores[scores >= limit]
    return sorted(((int(s), int(i)) for s, i in zip(scores, ids)), key=lambda p: (-p[0], p[1]))[:k]


def same_label(scan: Scan, number: int, label: int, anchor: np.ndarray, k: int) -> Pairs:
    """The anchor's first k other rows of its label in the block."""

    def keep(lower, upper):
        limit = _kth(lower, k)
        return np.ones(len(lower), bool) if limit is None else upper >= limit

    rows, scores = scan.scores(anchor, np.flatnonzero((scan.labels == label) & (scan.ids != number)), keep)
    return _best(scan.ids[rows], scores, k)


def other_labels(scan: Scan, label: int, anchor: np.ndarray, windows: Pairs, k: int) -> list[Pairs]:
    """For each window (least, most) of scores, the first k rows of other labels in the block."""

    def keep(lower, upper):
        wanted = np.zeros(len(lower), bool)
        for least, most in windows:
            can = (upper >= least) & (lower <= most)
            limit = _kth(lower[(lower >= least) & (upper <= most)], k)
            wanted |= can if limit is None else can & (upper >= limit)
        return wanted

    rows, scores = scan.scores(anchor, np.flatnonzero(scan.labels != label), keep)
    inside = [(scores >= least) & (scores <= most) for least, most in windows]
    return [_best(scan.ids[rows[i]], scores[i], k) for i in inside]


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The whole scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _chunks(anchors: DataFrame, chunk: int) -> tuple[DataFrame, int]:
    """Anchors (id, label, v, near), packed and numbered: (a_n, a_dims, …, chunk), and how many chunks."""
    parts = max(-(-anchors.count() // chunk), 1)
    packed = written(_packed(anchors.repartition(parts, "id"), chunk).withColumn("part", F.monotonically_increasing_id()), "hard-negatives-chunks")
    numbers = packed.select("part").withColumn("chunk", F.row_number().over(W.orderBy("part")) - 1)  # a number per chunk
    packed = packed.join(numbers, "part").drop("part")
    return packed.toDF(*[f"a_{c}" for c in packed.columns[:-1]], "chunk"), packed.count()


def _grid(blocks: DataFrame, n_blocks: int, chunks: DataFrame, n_chunks: int) -> DataFrame:
    """Each block of rows with each chunk of anchors, by the chunk's number and a salt over the blocks."""
    salts = max(-(-n_blocks // _BLOCKS_PER_CELL), 1)
    each = F.explode(F.sequence(F.lit(0), F.lit(max(n_chunks, 1) - 1)))
    rows = blocks.drop("near").withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")).withColumn("chunk", each)
    anchors = chunks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.join(anchors, ["chunk", "salt"])


def _scan(grid: DataFrame, each, k: int) -> DataFrame:
    """The best rows that `each(scan, anchors, near)` finds by key, merged over the blocks of a cell."""

    def flushed(best: dict[tuple, Pairs]) -> pa.RecordBatch:
        rows = [(*key, other, score) for key, pairs in best.items() for score, other in pairs]
        columns = list(zip(*rows)) if rows else [()] * len(_BEST_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_BEST_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, at = {}, None
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if at is not None and at != row["chunk"]:
                    yield flushed(best)
                    best = {}
                at = row["chunk"]
                if row["dims"] == row["a_dims"]:
                    anchors = Block(row, "a_")
                    for key, found in each(Scan(Block(row), anchors.largest()), anchors, row["a_near"]):
                        if found:
                            best[key] = sorted([*best.get(key, ()), *found], key=lambda p: (-p[0], p[1]))[:k]
        yield flushed(best)

    return grid.mapInArrow(run, _BEST)


def _first(best: DataFrame, k: int) -> DataFrame:
    """The first k rows of each key, ranked from 1."""
    order = W.partitionBy(*_KEYS).orderBy(F.col("score").desc(), "other")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    anchors: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchors` says of (id, label, v) which rows are anchors (all, if not given).
    """
    label = F.col(label) if isinstance(label, str) else label
    none = F.array().cast("array<bigint>")
    whole = written(whole_rows(rows, key, vector, label, scale).withColumn("near", none), "hard-negatives-rows")
    blocks = written(_packed(whole, block).withColumn("block", F.monotonically_increasing_id()), "hard-negatives-blocks")
    n_blocks = blocks.count()
    chosen = whole if anchors is None else whole.where(anchors)

    def find_positives(scan: Scan, a: Block, near):
        for i, (number, group) in enumerate(zip(a.ids.tolist(), a.labels.tolist())):
            yield (number, 0, 0), same_label(scan, number, group, a.vectors[:, i], positives)

    found = _scan(_grid(blocks, n_blocks, *_chunks(chosen, chunk)), find_positives, positives)
    # `positives` at most for each anchor
    near = _first(found, positives).groupBy("anchor").agg(F.flatten(F.collect_list(F.array("other", "score"))).alias("near"))
    matched = written(chosen.drop("near").join(near, F.col("id") == F.col("anchor")).drop("anchor"), "hard-negatives-anchors")

    def find_negatives(scan: Scan, a: Block, near):
        for i, (number, group) in enumerate(zip(a.ids.tolist(), a.labels.tolist())):
            with_score = [p for p in zip(near[i][::2], near[i][1::2]) if p[1] >= 0]
            windows = [window(score, low, high) for _, score in with_score]
            if windows:
                for p, best in zip(with_score, other_labels(scan, group, a.vectors[:, i], windows, negatives)):
                    yield (number, *p), best

    found = _scan(_grid(blocks, n_blocks, *_chunks(matched, chunk)), find_negatives, negatives)
    return _first(found, negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def digest_columns(rows: DataFrame) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; where it is divisible by 7, the label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, label=label, anchors=F.col("id") % 100 == 0)


#: The same rows from the scores of all pairs.
ORACLE = """
with good as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same,
    cast(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) as bigint) as score
  from good a join good r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
ranked as (
  select p.anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by score desc, id) as rank
  from positives p join scored s on s.anchor_id = p.anchor_id and not same
    and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from ranked where rank <= 10
"""

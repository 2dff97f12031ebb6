"""Quality classifier: random-indexing word vectors, pooled per document, into a small network.

1. *Word vectors.* Tokens (words as written, and runs of punctuation) fall into `BUCKETS` hash
   buckets. Each bucket has a sparse random index vector (`SIGNS` entries of +1 or -1 among `DIM`);
   a bucket's context vector is the sum of the index vectors of its neighbours, up to `REACH`
   tokens away, over all documents. Tasks add up their own documents; the sums of tasks are
   added in a tree of `FAN_IN`, whose pieces have a fixed size, so neither a task nor the driver
   holds more as the corpus grows. Sums are whole numbers: no order of addition changes them.
2. *Documents.* A text is the mean of its tokens' context vectors, each of length one.
3. *Network.* One hidden layer of `HIDDEN` units, fitted in numpy on at most `SAMPLE` labelled
   documents (those with the least hash of their key), with a fifth of them held back to choose
   the temperature that divides the logit, so that scores are probabilities.

Defined cases: null and empty texts have the zero vector and get the score the network gives it;
of several rows with one key the least vector is learned from; rows without a label, or labelled
null, are not learned from; if no labelled rows of both kinds are left, every score is the share
of label 1, or 0.5 without any label; other columns pass through, and a new column whose name is
taken gets `_` appended.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.llm.common import free_name, pieces, text_of
from macrospark.llm.words import U, mix, tokens

BUCKETS, DIM, SIGNS, REACH = 1 << 14, 64, 4, 2
FAN_IN = 32
HIDDEN = 32
SAMPLE = 20_000
THRESHOLD = 0.3

_BLOCKS = 16
_PIECE = 1_000_000
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Where each bucket's index vector is not zero, and its sign there."""
    draws = mix(np.arange(1, BUCKETS * SIGNS + 1, dtype=U) * U(0x9E3779B97F4A7C15)).reshape(BUCKETS, SIGNS)
    return (draws % U(DIM)).astype(np.int64), np.where(draws >> U(63), 1, -1).astype(np.int64)


_PLACES, _SIGNS = _index_vectors()


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all tokens in order, and where each text begins."""
    hashes, at = tokens(texts, fold=False, signs=True)
    return (hashes & U(BUCKETS - 1)).astype(np.int64), at


def _add_contexts(total: np.ndarray, texts: pa.Array) -> None:
    found, at = buckets(texts)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for reach in range(1, REACH + 1):
        same = text[reach:] == text[:-reach]
        left, right = found[:-reach][same], found[reach:][same]
        for here, there in ((left, right), (right, left)):
            for k in range(SIGNS):
                np.add.at(total, here * DIM + _PLACES[there, k], _SIGNS[there, k])


_PARTS = T.StructType(
    [T.StructField("part", T.LongType()), T.StructField("block", T.IntegerType()), T.StructField("data", T.BinaryType())]
)
_PARTS_ARROW = pa.schema([("part", pa.int64()), ("block", pa.int32()), ("data", pa.binary())])


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them, after one byte for the width."""
    most = int(np.abs(values).max(initial=0))
    width = next(i for i, w in enumerate(_WIDTHS) if most <= np.iinfo(w).max)
    return bytes([width]) + values.astype(_WIDTHS[width]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, _WIDTHS[data[0]], offset=1).astype(np.int64)


def _sum_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, part, block = None, 0, 0
    for batch in batches:
        for part, block, data in zip(*(c.to_pylist() for c in batch.columns)):
            total = _unpacked(data) if total is None else total + _unpacked(data)
    if total is not None:
        yield pa.RecordBatch.from_pylist([{"part": part, "block": block, "data": _packed(total)}], _PARTS_ARROW)


def added_up(parts: DataFrame, n: int) -> DataFrame:
    """Sum blocks over `n` parts, `FAN_IN` at a time."""
    while n > 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN))
        parts = parts.groupBy("part", "block").applyInArrow(_sum_group, _PARTS)
        n = -(-n // FAN_IN)
    return parts


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of length one, a row per bucket; of fixed size, whatever the corpus."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(BUCKETS * DIM, np.int64), None
        for batch in batches:
            if batch.num_rows:
                part = batch.column(1)[0].as_py()
            for piece in pieces(batch, 0, _PIECE):
                _add_contexts(total, piece.column(0))
        if part is not None:
            rows = [{"part": part, "block": i, "data": _packed(x)} for i, x in enumerate(np.split(total, _BLOCKS))]
            yield pa.RecordBatch.from_pylist(rows, _PARTS_ARROW)

    texts = docs.select(text_of(text).alias("t"), F.spark_partition_id().cast("long").alias("part"))
    parts = added_up(texts.mapInArrow(contexts, _PARTS), texts.rdd.getNumPartitions())
    blocks = {r["block"]: _unpacked(bytes(r["data"])) for r in parts.collect()}  # _BLOCKS rows
    size = BUCKETS * DIM // _BLOCKS
    sums = np.concatenate([blocks.get(i, np.zeros(size, np.int64)) for i in range(_BLOCKS)]).reshape(BUCKETS, DIM)
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """The mean vector of each text."""
    found, at = buckets(texts)
    out = np.zeros((len(at) - 1, DIM), np.float32)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = np.add.reduceat(vectors[found], at[:-1][full], axis=0) / np.diff(at)[full][:, None]
    return out


@dataclass
class Network:
    """Two layers; `temperature` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x.astype(float)) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def constant(share: float) -> Network:
    """A network that gives every text the same score."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    zero = np.zeros(DIM)
    return Network(zero, zero + 1, np.zeros((DIM, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, decay: float = 1e-4) -> Network:
    """Adam on the log loss, with a fixed seed; every fifth row is kept for the temperature."""
    if len(set(y.tolist())) < 2:
        return constant(float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(7)
    held = np.arange(len(y)) % 5 == 4
    x = x.astype(float)
    xt, yt = x[~held], y[~held].astype(float)
    scale = xt.std(0)
    net = Network(
        xt.mean(0), np.where(scale > 1e-6, scale, 1.0), rng.normal(0, (2 / DIM) ** 0.5, (DIM, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), 0.0,
    )
    xt = (xt - net.mean) / net.scale
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(yt))
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            h = np.maximum(xt[rows] @ weights[0] + weights[1], 0)
            error = (sigmoid(h @ weights[2] + weights[3][0]) - yt[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (h > 0)
            grads = [xt[rows].T @ back + decay * weights[0], back.sum(0), h.T @ error + decay * weights[2], np.array([error.sum()])]
            step += 1
            for j, g in enumerate(grads):
                m[j] += 0.1 * (g - m[j])
                v[j] += 0.001 * (g * g - v[j])
                weights[j] -= 2e-3 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if held.any():
        net.temperature = calibrated(net.logits(x[held]), y[held])
    return net


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, from 0.25 to 16 in steps of a twentieth of an octave."""
    tried = 2.0 ** (np.arange(-40, 81) / 20)
    losses = [np.mean(np.logaddexp(0, np.where(y > 0, -1, 1) * logits / t)) for t in tried]
    return float(tried[int(np.argmin(losses))])


def fold_of(key: str) -> Column:
    """0 to 4; rows of fold 0 are never learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", sample: int = SAMPLE):
    """(word vectors, network): vectors from all documents, the network from at most `sample` labelled ones."""
    vectors = word_vectors(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold_of(key) != 0))
    chosen = (
        known.groupBy(F.col(key).alias("k"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("k"), "k")
        .limit(sample)
    )
    rows = docs.select(text_of(text).alias("t"), F.col(key).alias("k")).join(F.broadcast(chosen), "k")  # `sample` rows at most

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                data = [x.tobytes() for x in pooled(piece.column(0), shared.value)]
                yield pa.RecordBatch.from_arrays([*piece.columns[1:], pa.array(data, pa.binary())], names=["k", "y", "x"])

    schema = T.StructType([rows.schema["k"], rows.schema["y"], T.StructField("x", T.BinaryType())])
    found = rows.select("t", "k", "y").mapInArrow(features, schema).groupBy("k", "y").agg(F.min("x").alias("x"))
    learned = found.orderBy(F.xxhash64("k"), "k").collect()  # `sample` rows at most
    x = np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in learned]).reshape(len(learned), DIM)
    return vectors, fit_network(x, np.array([r["y"] for r in learned], int))


def with_score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability of label 1."""
    name = free_name(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, net = shared.value
        for batch in batches:
            for piece in pieces(batch, at, _PIECE):
                found = pa.array(net.scores(pooled(piece.column(at), vectors)))
                yield pa.RecordBatch.from_arrays([*piece.columns, found], names=[*piece.schema.names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def digest_columns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", "text")
    scored = with_score(rows, fit(rows, labels, "quality"))
    return scored.select(
        "doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that the classifier does not reject, columns as they were."""
    name = free_name(docs, "_score")
    return with_score(docs, fit(docs, labels, label, key, text), text, name).where(F.col(name) >= THRESHOLD).drop(name)

"""Mixing to target weights by soft membership.

1. *Posteriors.* A softmax regression over hashed tokens (words and runs of punctuation), fitted on at most `SAMPLE` labelled
   documents (those with the least hash of their key), gives each document a probability for
   each domain; they sum to 1. Domains come from a labelled table.
2. *Rates.* Each document gets a rate r >= 0, so that the expected tokens of domain d, the sum of
   r * tokens * P(d), meet its target. Documents whose posteriors round to the same multiples of
   `STEP` form a cell, share their rate, and enter by the exact sums of their tokens * P(d): cells
   only save work. The rates start at 1 and descend by projected gradient on the squared misses:
   r <- max(0, r - sum_d q_d pull_d), where q is the cell's posterior. The pulls are the misses,
   weighed by the inverse of the D x D matrix of what the cells with a rate can still move
   (damped by `DAMPING`), since domains that share documents pull against each other. Each step is
   one aggregate over the cells (bounded by rounding), the steps end once each domain is within
   `TOLERANCE` of its own target, and a document's rate is an expression over its own cell. Targets
   that no rates reach end after `STEPS` steps with a warning that names what is missed.
3. *Copies.* A document is drawn floor(r + u) times, u being uniform by its key and text.

Targets are token shares, scaled so that the domain `anchor` keeps the tokens it has.

Defined cases: null and empty texts have no tokens and the posteriors the regression gives them;
a domain without labelled documents has probability 0, and its target is left out; without any labels all documents belong
to the anchor; if the anchor has no tokens, rates stay 1; labels null in a needed column are left
out; repeated rows are drawn alike; other columns pass through, and a new column whose name is
taken gets `_` appended.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.llm.common import free_name, node_of, pieces, text_of, written
from macrospark.llm.words import U, tokens

BUCKETS = 1 << 14
SAMPLE = 20_000
STEP = 0.01
STEPS = 60
#: Largest miss of a domain, as a share of its own target.
TOLERANCE = 1e-3
DAMPING = 0.01
#: Share of all tokens that each domain should have.
TARGETS = {"clean": 0.95, "toxic": 0.02, "low": 0.03}
ANCHOR = "clean"

_PIECE = 1_000_000


def domain_of_labels() -> Column:
    """The domain that the given labels name."""
    return F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")


def word_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct token buckets of each text: text number, bucket; and the tokens of each text."""
    hashes, at = tokens(texts, signs=True)
    counts = np.diff(at)
    keys = np.unique(np.repeat(np.arange(len(counts), dtype=U), counts) * U(BUCKETS) + (hashes & U(BUCKETS - 1)))
    return (keys // U(BUCKETS)).astype(np.int64), (keys % U(BUCKETS)).astype(np.int64), counts


class Regression:
    """Softmax over the weights of a text's distinct tokens; an L1 penalty keeps rare ones at zero."""

    def __init__(self, domains: list[str]):
        self.domains = domains
        self.weights = np.zeros((BUCKETS, len(domains)))
        self.bias = np.zeros(len(domains))

    def probabilities(self, text: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        z = np.stack([np.bincount(text, self.weights[bucket, d], n) for d in range(len(self.domains))], 1) + self.bias
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def fit(self, sets: list[np.ndarray], y: np.ndarray, epochs: int = 20, batch: int = 64, rate: float = 0.1, l1: float = 1e-3) -> None:
        """AdaGrad on the log loss, with a fixed seed."""
        rng = np.random.default_rng(11)
        squares, bias_squares = np.full_like(self.weights, 1e-2), np.full_like(self.bias, 1e-2)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(order), batch):
                rows = order[i : i + batch]
                text = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
                bucket = np.concatenate([sets[r] for r in rows]).astype(np.int64)
                error = self.probabilities(text, bucket, len(rows))
                error[np.arange(len(rows)), y[rows]] -= 1
                used, place = np.unique(bucket, return_inverse=True)
                grad = np.stack([np.bincount(place, error[text, d], len(used)) for d in range(len(self.domains))], 1) / len(rows)
                squares[used] += grad * grad
                step = rate / np.sqrt(squares[used])
                moved = self.weights[used] - step * grad
                self.weights[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
                bias = error.mean(0)
                bias_squares += bias * bias
                self.bias -= rate * bias / np.sqrt(bias_squares)


def fit_domains(
    docs: DataFrame, labels: DataFrame, domains: list[str], domain: Column, key: str, text: str, sample: int = SAMPLE
) -> Regression:
    """The regression from labelled documents; `sample` rows of bounded size reach the driver."""
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(domain).alias("d"))
    chosen = known.where(F.col("d").isin(domains)).orderBy(F.xxhash64("k"), "k").limit(sample)
    rows = docs.select(text_of(text).alias("t"), F.col(key).alias("k")).join(F.broadcast(chosen), "k")
    schema = T.StructType([rows.schema["k"], rows.schema["d"], T.StructField("x", T.BinaryType())])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                of, bucket, _ = word_sets(piece.column(0))
                ends = np.searchsorted(of, np.arange(piece.num_rows + 1))
                data = [bucket[a:b].astype(np.uint16).tobytes() for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*piece.columns[1:], pa.array(data, pa.binary())], names=["k", "d", "x"])

    found = rows.select("t", "k", "d").mapInArrow(features, schema).groupBy("k", "d").agg(F.min("x").alias("x"))
    learned = found.orderBy(F.xxhash64("k"), "k").collect()  # `sample` rows at most, of BUCKETS words at most
    model = Regression(sorted({r["d"] for r in learned}) or domains[:1])
    if len(model.domains) > 1:
        sets = [np.frombuffer(bytes(r["x"]), np.uint16) for r in learned]
        model.fit(sets, np.array([model.domains.index(r["d"]) for r in learned]))
    return model


def with_posteriors(docs: DataFrame, model: Regression, domains: list[str], text: str, name: str) -> DataFrame:
    """Add a struct: tokens of the text, and the probability of each domain in order, as it is and rounded."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    numbers = T.ArrayType(T.DoubleType())
    kind = T.StructType([T.StructField("tokens", T.LongType()), T.StructField("p", numbers), T.StructField("cell", numbers)])
    arrow = pa.struct([("tokens", pa.int64()), ("p", pa.list_(pa.float64())), ("cell", pa.list_(pa.float64()))])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        order = [known.domains.index(d) if d in known.domains else -1 for d in domains]
        for batch in batches:
            for piece in pieces(batch, at, _PIECE):
                of, bucket, counts = word_sets(piece.column(at))
                p = known.probabilities(of, bucket, piece.num_rows)
                p = np.hstack([p, np.zeros((len(p), 1))])[:, order]
                ends = pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1])
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (p, np.round(p / STEP) * STEP)]
                lists = [x.cast(arrow.field(1).type) for x in lists]
                found = pa.StructArray.from_arrays([pa.array(counts.astype(np.int64)), *lists], fields=list(arrow))
                yield pa.RecordBatch.from_arrays([*piece.columns, found], names=[*piece.schema.names, name])

    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def rates(
    posteriors: DataFrame, p: list[Column], cell: list[Column], tokens_of: Column, domains: list[str], targets: Mapping[str, float], anchor: str
) -> Column:
    """The rate as an expression over the rounded posteriors `cell`, found by projected gradient descent."""
    d = len(domains)
    cells = posteriors.groupBy(*[x.alias(f"q{i}") for i, x in enumerate(cell)]).agg(
        *[F.sum(tokens_of * x).alias(f"s{i}") for i, x in enumerate(p)]
    )
    cells = written(cells, "mixing-cells")
    q, s = [F.col(f"q{i}") for i in range(d)], [F.col(f"s{i}") for i in range(d)]

    def totals(rate: Column) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of each domain, and what a pull of each domain takes from each."""
        movable = [F.sum(F.when(F.col("r") > 0, x * y)) for x in s for y in q]
        row = cells.withColumn("r", rate).agg(*[F.sum(x * F.col("r")) for x in s], *movable).first()
        found = np.array([x or 0.0 for x in row])
        return found[:d], found[d:].reshape(d, d)

    here, there = F.lit(1.0), F.lit(1.0)
    have, moved = totals(here)
    kept = have[domains.index(anchor)]
    if not kept or not targets[anchor]:
        return there
    want = np.where(have > 0, np.array([targets[x] for x in domains]) * kept / targets[anchor], 0.0)
    # relative misses: each domain's row and pull in units of its own tokens
    size = np.where(have > 0, np.maximum(have, want), 1.0)
    damping = DAMPING * np.diag(np.where(have > 0, np.diag(moved) / size, 1.0))
    for _ in range(STEPS):
        missed = have - want
        if (np.abs(missed) <= TOLERANCE * want).all():
            return there
        pulls = np.linalg.lstsq(moved / size[:, None] + damping, missed / size, rcond=None)[0]
        step = lambda r, ps: F.greatest(F.lit(0.0), r - sum(x * F.lit(float(g)) for x, g in zip(ps, pulls)))
        here, there = step(here, q), step(there, cell)
        have, moved = totals(here)
    short = {x: f"{h:.6g} of {w:.6g}" for x, h, w in zip(domains, have, want) if abs(h - w) > TOLERANCE * w}
    if short:
        warnings.warn(f"expected tokens that miss their targets after {STEPS} steps: {short}", stacklevel=2)
    return there


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: Mapping[str, float] = TARGETS,
    anchor: str = ANCHOR,
    domain: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    names: tuple[str, str, str] = ("membership", "rate", "copies"),
) -> DataFrame:
    """Add each document's membership (tokens, p, cell), rate, and number of copies to draw."""
    domains = list(targets)
    membership, rate_name, copies = (free_name(docs, n) for n in names)
    model = fit_domains(docs, labels, domains, domain_of_labels() if domain is None else domain, key, text)
    known = with_posteriors(docs, model, domains, text, membership)
    p, cell = ([F.col(membership)[x][i] for i in range(len(domains))] for x in ("p", "cell"))
    rate = rates(known, p, cell, F.col(membership)["tokens"], domains, targets, anchor)
    uniform = F.shiftrightunsigned(F.xxhash64(F.col(key), node_of(text)), 11).cast("double") / F.lit(float(2**53))
    return known.withColumn(rate_name, rate).withColumn(copies, F.floor(F.col(rate_name) + uniform))


def mixed(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Each document as often as it is drawn, columns as they were."""
    names = tuple(free_name(docs, n) for n in ("_membership", "_rate", "_copies"))
    drawn = mix(docs, labels, names=names, **options).where(F.col(names[2]) > 0)
    spare = free_name(docs, "_i")
    return drawn.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(names[2]))).alias(spare)).drop(spare)


def digest_columns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, tokens, the probability of each domain, rate and copies."""
    found = mix(docs.select("doc_id", "text"), labels)
    return found.select(
        "doc_id",
        F.col("membership.tokens").alias("tokens"),
        *[F.col("membership.p")[i].alias(f"p_{d}") for i, d in enumerate(TARGETS)],
        "rate",
        "copies",
    )

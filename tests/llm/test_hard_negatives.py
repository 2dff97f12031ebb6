"""Hard negatives against the scores of all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from macrospark.llm import hard_negatives as hn

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows, every=10, positives=5, negatives=10):
    good = {}
    for number, vector, label in rows:
        if number is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, [math.floor(256 * x) for x in vector])
        good[number] = min(good.get(number, row), row)
    out = []
    for a, (label, q) in good.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in good.items() if i != a and len(v) == len(q)]
        near = sorted((s, i) for s, i, other in scores if other == label)[:positives]
        for minus, p in near:
            inside = sorted((s, i) for s, i, other in scores if other != label and 30 * -minus <= 100 * -s <= 90 * -minus)
            out += [(a, p, rank, i, -minus, -s) for rank, (s, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def found(frame, every=10, **options):
    return sorted(tuple(r) for r in hn.hard_negatives(frame, anchors=F.col("id") % every == 0, **options).collect())


def vectors(n, dims, labels, seed, digits=8):
    random.seed(seed)
    return [(i, [round(random.gauss(0, 0.4), digits) for _ in range(dims)], random.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("block,chunk", [(8192, 1024), (37, 7)])
def test_equals_all_pairs(spark, block, chunk):
    rows = vectors(700, 20, 4, 1)
    rows += [(1000 + i, [0.5] * 20, 1) for i in range(200)]  # one very common vector: ties everywhere
    rows = [(i, [struct32(x) for x in v], label) for i, v, label in rows]
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    expected = brute(rows)
    assert len(expected) > 500
    assert found(frame, block=block, chunk=chunk) == expected


def struct32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_scores_beyond_floating_point(spark):
    """Components so large that sums of products are not exact in 53 bits."""
    rows = [(i, [x * 3e6 + 1 / 256 for x in v], label) for i, v, label in vectors(150, 6, 3, 2)]
    ddl = DDL.replace("float", "double")
    assert max(abs(r[4]) for r in brute(rows, 5)) > 1 << 53
    assert found(spark.createDataFrame(rows, ddl), 5) == brute(rows, 5)
    with pytest.raises(Exception, match="beyond 64 bits"):
        found(spark.createDataFrame([(0, [1e30], 1)], ddl))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [struct32(x) for x in v], label) for i, v, label in vectors(60, 5, 2, 3)]
    rows += [(None, [1.0] * 5, 1), (70, None, 1), (71, [1.0] * 5, None), (72, [nan] * 5, 0), (73, [inf] * 5, 0), (74, [None] * 5, 0)]
    rows += [(80, [], 1), (81, [], 0), (82, [0.5] * 3, 1), (90, [0.5] * 3, 1), (91, [0.25] * 3, 0), (92, [0.0] * 5, 1), (10, [9.0] * 5, 9)]
    rows += rows[:20]
    frame = spark.createDataFrame([(*r, 1) for r in rows], DDL + ", score int").repartition(3)
    assert found(frame) == brute(rows)
    assert found(spark.createDataFrame([], DDL)) == []


def test_windows_are_exact():
    for score in range(0, 400):
        low, high = hn.window(score)
        assert [s for s in range(-5, 400) if 30 * score <= 100 * s <= 90 * score] == list(range(low, high + 1))


def test_bounds_prune():
    """Most rows leave the bitmap before all dimensions are read."""
    import numpy as np

    rng = np.random.default_rng(1)
    block = hn.Block.__new__(hn.Block)
    centres = rng.integers(-200, 200, (40, 64))
    block.ids, block.labels = np.arange(4000), np.zeros(4000, int)
    block.vectors = (centres[np.arange(4000) % 40] * np.exp(-np.arange(64) / 8)).astype(int).T + rng.integers(-2, 3, (64, 4000))
    scan, left = hn.Scan(block, 200), []

    def keep(lower, upper):
        wanted = upper >= np.partition(lower, -5)[-5] if len(lower) >= 5 else np.ones(len(lower), bool)
        left.append(int(wanted.sum()))
        return wanted

    scan.scores(block.vectors[:, 7], np.arange(4000), keep)
    assert left[0] < 4000 and left[2] < 400

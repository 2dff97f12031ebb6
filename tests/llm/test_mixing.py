import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from macrospark.llm import mixing
from macrospark.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("sf, rows", [("0.01", 1000), ("0.1", 10_000)])
def test_expected_totals_meet_the_targets(spark, sf, rows):
    sf = f"/root/testdata/sf{sf}"
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        out = mixing.digest_columns(table(spark, sf, "documents"), table(spark, sf, "labels")).toPandas()
    assert len(out) == rows and (out["rate"] >= 0).all()
    p = out[[f"p_{d}" for d in mixing.TARGETS]].to_numpy()
    totals = (out["rate"] * out["tokens"]).to_numpy() @ p
    budget = (out["tokens"].to_numpy() @ p)[0] / mixing.TARGETS["clean"]
    want = np.array(list(mixing.TARGETS.values())) * budget
    assert np.allclose(p.sum(1), 1) and (np.abs(totals - want) < 0.01 * want).all()
    drawn = (out["copies"] * out["tokens"]).sum()
    assert abs(drawn / (out["rate"] * out["tokens"]).sum() - 1) < 0.05


def frame_of(spark, p, n):
    rows = [(i, int(k), [float(x) for x in q], [float(round(x, 2)) for x in q]) for i, (k, q) in enumerate(zip(n, p))]
    frame = spark.createDataFrame(rows, "i long, n long, p array<double>, cell array<double>")
    return frame, [F.col("p")[j] for j in range(3)], [F.col("cell")[j] for j in range(3)]


def test_rates_meet_each_target_of_unrounded_posteriors(spark):
    rng = np.random.default_rng(4)
    targets = {"a": 0.9, "b": 0.08, "c": 0.02}
    for sharp in (0.05, 0.3, 1.0):
        p, n = rng.dirichlet([4 * sharp, sharp, sharp], 400), rng.integers(0, 1000, 400)
        frame, ps, cell = frame_of(spark, p, n)
        rate = mixing.rates(frame, ps, cell, F.col("n"), list(targets), targets, "a")
        r = np.array([x[0] for x in frame.orderBy("i").select(rate).collect()])
        want = np.array(list(targets.values())) * (n @ p)[0] / 0.9
        assert (r >= 0).all() and (np.abs((r * n) @ p - want) <= 1.01 * mixing.TOLERANCE * want).all()


def test_targets_out_of_reach_are_reported(spark):
    # every document is half b: b cannot become a tenth
    p, n = np.array([[0.5, 0.5, 0.0]] * 9), np.full(9, 10)
    frame, ps, cell = frame_of(spark, p, n)
    targets = {"a": 0.8, "b": 0.1, "c": 0.1}
    with pytest.warns(UserWarning, match="'b'"):
        rate = mixing.rates(frame, ps, cell, F.col("n"), list(targets), targets, "a")
    assert all(0 < x[0] < 1 for x in frame.select(rate).collect())


def test_held_out_toxic_documents_are_told_apart(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    known = labels.where("doc_id % 3 <> 0")
    out = mixing.digest_columns(docs, known).toPandas().merge(labels.where("doc_id % 3 = 0").toPandas(), on="doc_id")
    toxic, clean = out.query("toxic == 1 and quality == 1"), out.query("toxic == 0 and quality == 1")
    assert clean["rate"].mean() > toxic["rate"].mean() + 0.4


def test_odd_rows(spark, odd, none, labels):
    out = mixing.mix(odd, labels).collect()
    assert len(out) == 10 and {r["rate"] for r in out} == {1.0} and {r["copies"] for r in out} == {1}
    some = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (7, 1, 1), (5, 0, None), (4, None, None), (None, 1, 1)], labels.schema)
    assert mixing.mix(odd, some).count() == 10
    assert mixing.mix(none, some).count() == 0 and mixing.mixed(none, labels).count() == 0
    taken = odd.withColumnRenamed("key", "rate").withColumnRenamed("node", "copies")
    assert mixing.mixed(taken, some).columns == taken.columns
    assert mixing.mix(taken, some).columns[-3:] == ["membership", "rate_", "copies_"]

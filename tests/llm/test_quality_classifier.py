import numpy as np

from macrospark.llm import quality
from macrospark.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = table(spark, SF, "labels").toPandas()
    scored = quality.digest_columns(table(spark, SF, "documents"), table(spark, SF, "labels")).toPandas()
    assert len(scored) == 1000 and scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.3)).all()
    held = scored.merge(labels, on="doc_id").query("held_out")
    good, bad = held.query("quality == 1"), held.query("quality == 0")
    ranks = (good["score"].to_numpy()[:, None] > bad["score"].to_numpy()[None, :]).mean()
    assert ranks > 0.85
    assert good["predicted"].mean() > 0.97 and bad["predicted"].mean() < 0.6


def test_scores_do_not_depend_on_the_layout(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    one = {r["doc_id"]: r["score"] for r in quality.digest_columns(docs.coalesce(1), labels).collect()}
    many = {r["doc_id"]: r["score"] for r in quality.digest_columns(docs.repartition(40, "doc_id"), labels).collect()}
    assert one.keys() == many.keys()
    assert max(abs(one[k] - many[k]) for k in one) < 1e-6


def test_context_vectors_equal_a_plain_sum(spark):
    texts = ["a b c, a", "b", None, "c a"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    import pyarrow as pa

    want = np.zeros((quality.BUCKETS, quality.DIM))
    found, at = quality.buckets(pa.array(texts))
    for first, end in zip(at[:-1], at[1:]):
        for i in range(first, end):
            for j in range(max(first, i - quality.REACH), min(end, i + quality.REACH + 1)):
                if i != j:
                    for place, sign in zip(quality._PLACES[found[j]], quality._SIGNS[found[j]]):
                        want[found[i], place] += sign
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(quality.word_vectors(frame), want, atol=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-z))).astype(int)
    assert abs(quality.calibrated(3 * z, y) - 3) < 0.3


def test_odd_rows(spark, odd, none, labels):
    rows = quality.digest_columns(odd, labels).collect()
    assert len(rows) == 10 and {r["score"] for r in rows} == {0.5}
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, None, 0), (None, 1, 0), (7, 1, 1), (7, 0, 0)], labels.schema)
    rows = quality.digest_columns(odd, some).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality.digest_columns(none, some).count() == 0
    assert quality.accepted(odd.withColumnRenamed("key", "_score"), labels).columns == ["doc_id", "text", "node", "_score"]

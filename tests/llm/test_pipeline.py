import corpus_pipeline as pipeline

from macrospark.llm import decontaminate, near_dedup, quality
from macrospark.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_another(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality_classifier", "near_dedup", "decontaminate", "mix", "shard"]
    stage = dict(pipeline.STAGES)

    scored = quality.with_score(docs, quality.fit(docs, table(spark, SF, "labels"), "quality"))
    good = written(stage["quality_classifier"](spark, docs, SF), "t")
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scored.where("score >= 0.3").collect()}

    single = written(stage["near_dedup"](spark, good, SF), "t")
    classes = {r["doc_id"]: r["class_id"] for r in near_dedup.digest_columns(good).collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(classes.values()))

    clean = written(stage["decontaminate"](spark, single, SF), "t")
    hit = decontaminate.digest_columns(single, table(spark, SF, "benchmark")).where("contaminated").collect()
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - {r["doc_id"] for r in hit}

    mixed = written(stage["mix"](spark, clean, SF), "t")
    assert mixed.columns == docs.columns
    final = stage["shard"](spark, mixed, SF)
    assert final.columns == [*docs.columns, "shard"] and final.count() == mixed.count()
    assert sorted(map(repr, pipeline.run(spark, SF).collect())) == sorted(map(repr, final.collect()))


def test_every_stage_takes_empty_and_odd_tables(spark, odd, none):
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
        out = stage(spark, odd.withColumnRenamed("key", "shard"), SF)
        assert out.columns[:4] == ["doc_id", "text", "node", "shard"]
        out.collect()

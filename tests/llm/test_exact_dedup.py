from pyspark.sql import functions as F

from macrospark.llm.exact_dedup import exact_dedup, read_state


def expected(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    return sorted(
        (repr(k), repr(max((x for x in groups[t or ""] if x is not None), default=None)), len(groups[t or ""])) for k, t in rows
    )


def found(df):
    rows = df.collect()
    return sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"]) for r in rows), rows


def test_odd_rows(spark, odd, none, tmp_path):
    odd.repartition(3).write.parquet(str(tmp_path / "docs"))
    got, rows = found(exact_dedup(spark, str(tmp_path / "docs")))
    assert got == expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    kept = [r["digest"] for r in rows if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["digest"] for r in rows})  # one of each text, ties too
    none.write.parquet(str(tmp_path / "none"))
    assert exact_dedup(spark, str(tmp_path / "none")).count() == 0


def test_colliding_digests_are_told_apart_by_their_bytes(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "docs"))
    weak = lambda text: F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 0)
    got, rows = found(exact_dedup(spark, str(tmp_path / "docs"), digest=weak))
    assert got == expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert sum(r["kept"] for r in rows) == len({r["text"] or "" for r in odd.collect()})


def test_a_second_run_goes_on_from_the_state(spark, tmp_path):
    path, checkpoint = str(tmp_path / "docs"), str(tmp_path / "state")
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").write.parquet(path)
    exact_dedup(spark, path, checkpoint=checkpoint).count()
    spark.createDataFrame([(3, "a"), (4, "c")], "doc_id long, text string").write.mode("append").parquet(path)
    rows = exact_dedup(spark, path, checkpoint=checkpoint).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows} == {
        (1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True)
    }
    assert read_state(spark, checkpoint).count() == 3

import hashlib
import random

import numpy as np
import pytest

from macrospark.llm import substring_dedup
from macrospark.llm.substring_dedup import dedup_substrings
from macrospark.llm.suffix_array import prefix_ranks, suffix_array


@pytest.mark.parametrize("alphabet", [1, 2, 3, 200])
def test_suffix_array_equals_sorting(alphabet):
    rng = random.Random(alphabet)
    for n in [0, 1, 2, *range(3, 60), 500]:
        s = [rng.randrange(alphabet) for _ in range(n)]
        assert suffix_array(s) == sorted(range(n), key=lambda i: s[i:])


def brute(rows, length):
    seen, out = set(), {}
    order = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).digest())
    for key, text in sorted(set((k, t or "") for k, t in rows), key=order):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[key, text] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((k, *out[k, t or ""]) for k, t in rows), key=repr)


@pytest.mark.parametrize("crowd, splits, few", [(2000, (8, 1), 10**6), (2, (8, 1), 10**6), (1, (4, 1), 0)])
def test_equals_brute_force(spark, crowd, splits, few):
    rng = random.Random(crowd)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(12)]
    rows = []
    for i in range(40):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        if rows and rng.random() < 0.5:
            other = rng.choice(rows)[1]
            cut = rng.randint(0, len(other))
            text += other[cut : cut + rng.randint(0, 120)] + text[:30]
        rows.append((i, text))
    rows += [(100, rows[5][1]), (3, None), (None, rows[7][1]), (102, "ab" * 200), (103, "ab" * 150 + "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_substrings(df, length=20, gram=6, crowd=crowd, splits=splits, broadcast_keys=few).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 20)


def test_odd_rows(spark, odd, none):
    got = dedup_substrings(odd).collect()
    assert len(got) == 10
    long = [r for r in got if r["doc_id"] == 5][0]
    assert (long["n_bytes"], long["n_removed"], long["n_spans"]) == (150_000, 149_995, 1)
    assert all(not r["n_removed"] for r in got if r["doc_id"] != 5)
    assert dedup_substrings(none).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 5, 7, 30, 100])
def test_ranks_compare_so_many_symbols(depth):
    rng = random.Random(depth)
    s = [rng.randrange(3) for _ in range(60)] * 3 + [7]
    rank, cut = prefix_ranks(np.array(s), depth), [s[i : i + depth] for i in range(len(s))]
    for i in range(len(s)):
        for j in range(len(s)):
            assert (cut[i] < cut[j], cut[i] == cut[j]) == (rank[i] < rank[j], rank[i] == rank[j])


def test_marks_travel_only_with_keys_that_need_them(spark, monkeypatch):
    frames, write = {}, substring_dedup.written
    monkeypatch.setattr(substring_dedup, "written", lambda df, label, *a: frames.setdefault(label, write(df, label, *a)))
    text = "".join(random.Random(1).choices("abcdefgh", k=300))
    rows = [(1, text), (2, text[:200] + "x"), (2, "y" + text[50:250]), (None, text[100:] + "z"), (4, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_substrings(df).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 100)
    marked = frames["substring-rows"].groupBy("id").agg({"mark": "count", "*": "count"}).collect()
    assert {r["id"]: bool(r["count(mark)"]) for r in marked} == {1: False, 2: True, None: True}
    assert frames["substring-spans"].schema["spans"].dataType.simpleString() == "array<bigint>"


def shared_passage():
    """Texts around one passage, with rows that come twice, two texts of one key and one of none."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    passage = word(40)
    rows = [(i, word(15 + i) + passage + word(15)) for i in range(8)]
    return rows + [rows[3], rows[0], rows[0], (2, word(9) + passage), (None, passage + word(9)), (9, passage), (9, passage), (10, "short")]


def test_rows_of_other_keys_do_not_move_to_find_the_crowded(spark, monkeypatch, capsys):
    plans, write = [], substring_dedup.written

    def traced(df, label, *a):
        if label == "substring-split":
            capsys.readouterr()
            df.explain()
            plans.append(capsys.readouterr().out)
        return write(df, label, *a)

    monkeypatch.setattr(substring_dedup, "written", traced)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table that is too large for Spark's own choice
    try:
        rows = shared_passage()
        got = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), length=20, gram=6, crowd=2).drop("kept").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 20)
    assert plans and all("BroadcastHashJoin" in p and "hashpartitioning" not in p for p in plans)


def test_segments_travel_without_bytes_to_many_keys(spark, monkeypatch):
    frames, write = {}, substring_dedup.written
    monkeypatch.setattr(substring_dedup, "written", lambda df, label, *a: frames.setdefault(label, write(df, label, *a)))
    rows = shared_passage()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_substrings(df, length=20, gram=6, broadcast_keys=0).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 20)
    assert "segment" not in frames["substring-places"].columns
    names = ["key", "lead", "start", "windows", "id", "mark", "segment"]
    kept = {tuple(map(repr, r)) for r in frames["substring-rows"].select(*names).collect()}
    frames.clear()
    dedup_substrings(df, length=20, gram=6).count()
    assert kept == {tuple(map(repr, r)) for r in frames["substring-rows"].select(*names).collect()}

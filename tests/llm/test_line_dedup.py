import random

import pytest

from macrospark.llm.line_dedup import dedup_lines, selected_positions


def brute(rows, run):
    seen, out = set(), {}
    for key, text in sorted(set((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - run + 1):
            window = tuple(lines[i : i + run])
            if window in seen:
                gone |= set(range(i, i + run))
            seen.add(window)
        out[key, text] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return sorted(((k, *out[k, t or ""]) for k, t in rows), key=repr)


@pytest.mark.parametrize("run, gram", [(3, 2), (4, 2), (5, 1), (2, 2), (1, 1)])
def test_equals_brute_force(spark, run, gram):
    rng = random.Random(run)
    rows = []
    for i in range(60):
        lines = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))]
        if rows and rng.random() < 0.5:
            lines += rng.choice(rows)[1].split("\n")[rng.randint(0, 4) :]
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in dedup_lines(df, run=run, gram=gram).collect()), key=repr)
    assert got == brute(rows, run) and any(r[2] for r in got)


def test_short_runs_of_many_words_equal_brute_force(spark):
    rng = random.Random(9)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (1, 2, 4, 6, 7, 12, 15)]
    rows = [(i, "\n".join([f"only {i}", *rng.choices(pool, k=rng.randint(0, 4)), f"end {i}"])) for i in range(60)]
    rows += [(100, pool[-1]), (101, pool[-1]), (102, pool[0]), (103, pool[0])]
    seen, want = set(), []
    for key, text in rows:
        lines, gone = text.split("\n"), set()
        for i in range(len(lines)):
            for n in range(1, min(3, len(lines) - i) + 1):
                window = tuple(lines[i : i + n])
                if n == 3 or sum(len(x.split()) for x in window) >= 10:
                    if window in seen:
                        gone |= set(range(i, i + n))
                    seen.add(window)
        want.append((key, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in dedup_lines(df, words=10).collect()) == want
    plain = {r["doc_id"]: r["n_removed"] for r in dedup_lines(df).collect()}
    assert any(n > plain[k] for k, _, n, _ in want) and plain[101] == 0


def test_odd_rows(spark, odd, none):
    got = dedup_lines(odd, run=1, gram=1).collect()
    assert len(got) == 10
    assert {(r["doc_id"], r["n_removed"]) for r in got if r["n_removed"]} == {(2, 1), (4, 1)}
    assert dedup_lines(none).count() == 0


def test_windows_select_few_positions_and_the_same_in_every_copy(spark):
    rng = random.Random(4)
    passage = [f"passage {i}" for i in range(40)]
    lines = lambda n: [f"line {rng.random()}" for _ in range(n)]
    texts = [lines(200) + passage + lines(7), lines(3) + passage + lines(90)]
    df = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = selected_positions(df, "doc_id", "text", 3, 1, None).collect()
    chosen = {i: [r for r in rows if r["key"] == i] for i in (0, 1)}
    for i, text in enumerate(texts):
        # one row per selected position, fewer than two thirds of the lines; each window selects once
        assert len({r["line"] for r in chosen[i]}) == len(chosen[i]) < len(text) * 2 / 3
        starts = sorted(r["line"] - w["left"] for r in chosen[i] for w in r["windows"])
        assert starts == list(range(len(text) - 2))
    # windows inside the passage select the same of its lines in both texts
    inside = [
        {r["line"] - at for r in chosen[i] if any(0 <= r["line"] - w["left"] - at <= 37 for w in r["windows"])}
        for i, at in ((0, 200), (1, 3))
    ]
    assert inside[0] == inside[1] and len(inside[0]) > 10


def test_passage_in_a_third_of_all_documents(spark):
    rng = random.Random(5)
    passage = "\n".join(f"shared {i}" for i in range(5))
    rows = []
    for i in range(300):
        own = "\n".join(f"{i} {rng.random()}" for _ in range(rng.randint(1, 4)))
        rows.append((i, f"{own}\n{passage}\n{i} end" if i % 3 == 0 else own))
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 3)
    assert {r["doc_id"] for r in got if r["n_removed"] == 5} == set(range(3, 300, 3))

import random
import re

import pytest

from macrospark.llm.decontaminate import Searcher, clean, digest_columns, find_contamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        x = words(item)
        m = min(window, len(x))
        patterns = {tuple(x[i : i + m]) for i in range(len(x) - m + 1)} if m else set()
        for i in range(len(w) - m + 1):
            if m and tuple(w[i : i + m]) in patterns:
                hit |= set(range(i, i + m))
                names.add(name)
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "Cc", "12"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(i), text(rng.randint(0, 14))) for i in range(8)]
    searcher = Searcher(items, 5)
    for _ in range(50):
        value = text(rng.randint(0, 40))
        n, spans, names = searcher.search(value)
        assert (n, sum(b - a for a, b in spans), sorted(names)) == brute(value, items, 5)


def test_blocks_of_items_add_up(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(12)) for i in range(6)] + [(6, "a b"), (7, None), (7, ""), (0, "c c c")]
    docs = [(i, text(60)) for i in range(20)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    out = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), frame, window=6, block_bytes=30).collect()
    for row in out:
        c = row["contamination"]
        want = brute(row["text"], [(str(i), t) for i, t in items], 6)
        assert (c["n_words"], sum(h["end"] - h["first"] for h in c["hits"]), c["items"]) == want


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(None, "five SIX"), (2, ""), (3, None), (4, "wörds àre")], "item_id long, text string")
    rows = digest_columns(odd, items).collect()
    assert len(rows) == 10
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {1, 2, 7}
    empty = [r for r in rows if r["doc_id"] == 3][0]
    assert (empty["n_words"], empty["n_hit"], empty["n_items"]) == (0, 0, 0)
    assert digest_columns(none, items).count() == 0
    assert digest_columns(odd, items.limit(0)).where("contaminated").count() == 0
    assert clean(odd, items).columns == odd.columns
    taken = odd.withColumnRenamed("key", "contamination")
    assert clean(taken, items).columns == taken.columns and clean(taken, items).count() == 6

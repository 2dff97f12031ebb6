import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from macrospark.llm import near_dedup
from macrospark.llm.components import components
from macrospark.llm.near_dedup import band_keys, common_shingles, digest_columns, learn_weights, one_per_class, prefix_keys
from macrospark.llm.words import shingles


def shingle_bag(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes(pairs):
    out = {}
    for node, label in pairs:
        out.setdefault(label, set()).add(node)
    return {frozenset(v) for v in out.values()}


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    docs, passage = [], [rng.choice(words) for _ in range(40)]
    for i in range(80):
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        if i % 3 == 0:
            base = passage + base
        docs.append(base)
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(copy)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


def test_classes_equal_all_pairs_by_brute_force(spark):
    rows = corpus(5)
    bags = {i: shingle_bag(t) for i, t in rows}
    n = len(rows)
    df = Counter(s for b in bags.values() for s in b)
    idf = {s: math.log1p(n / max(d, 0.01 * n)) for s, d in df.items()}
    links = []
    for a in bags:
        for b in bags:
            if a < b:
                both = bags[a].keys() & bags[b].keys()
                shared = sum(min(bags[a][s], bags[b][s]) * idf[s] for s in both)
                total = sum(sum(c * idf[s] for s, c in bags[x].items()) for x in (a, b)) - shared
                if shared >= 0.8 * total:
                    links.append((a, b))
    root = {i: i for i in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = digest_columns(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i in bags}
    assert len(links) > 30


def family(seed, n):
    """Texts of one group: each is an earlier one, or mostly the last one, with a few words changed."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    texts = [[rng.choice(words) for _ in range(70)]]
    while len(texts) < n:
        copy = list(texts[-1] if rng.random() < 0.6 else rng.choice(texts[-200:]))
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(copy[rng.choice([0, 0, 0, 1]) :] + [rng.choice(words)])
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_links_within_buckets_equal_brute_force_in_a_large_group_of_near_copies(spark):
    rows = family(11, 3000)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    weigh = learn_weights(frame, "text")
    text, ids, times = shingles(pa.array([t for _, t in rows]))
    weights = weigh(ids, times)
    which, keys = band_keys(text, ids, weights, 10, 3)
    bags = {i: {} for i, _ in rows}
    for i, s, w in zip(text.tolist(), ids.tolist(), weights.tolist()):
        bags[i][s] = w
    totals = {i: sum(b.values()) for i, b in bags.items()}
    buckets = {}
    for i, found in zip(which.tolist(), keys.tolist()):
        for k in found:
            buckets.setdefault(k, set()).add(i)
    root = {i: i for i in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(a, b) for found in buckets.values() for a in found for b in found if a < b}:
        shared = sum(min(w, bags[b][s]) for s, w in bags[a].items() if s in bags[b])
        if shared >= 0.8 * (totals[a] + totals[b] - shared):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    want = {}
    for i in root:
        want.setdefault(find(i), set()).add(i)
    got = classes((r["doc_id"], r["class_id"]) for r in digest_columns(frame).collect())
    assert 100 < len(want) < 2900
    # links beyond the buckets may be found too, but none within them may be missed
    assert [c for c in want.values() if not any(c <= g for g in got)] == []


def test_pairs_in_a_large_group_of_near_copies_are_few(spark, monkeypatch):
    """Texts of one group that are just not similar enough are told apart without a comparison."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    base, rows = [rng.choice(words) for _ in range(150)], []
    for i in range(600):
        copy = list(base)
        copy[rng.randrange(5, 145)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(rng.choices(words, k=60))) for i in range(600)]
    compared, verified = [], near_dedup.verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_dedup, "verified", counted)
    got = digest_columns(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id < 1000")
    assert got.select("class_id").distinct().count() > 300
    assert sum(compared) < 20 * 600, compared


def test_similar_texts_share_a_prefix_key():
    rows = family(3, 400)
    text, ids, times = shingles(pa.array([t for _, t in rows]))
    rng = np.random.default_rng(4)
    spread = np.exp(rng.normal(0, 1, 997))[(ids % 997).astype(int)]
    weights = (times * spread).astype(np.float32)
    _, at, df = np.unique(ids, return_inverse=True, return_counts=True)
    which, keys, _, _ = prefix_keys(text, ids, weights, df[at], 0.8)
    held = {i: set() for i, _ in rows}
    for i, k in zip(which.tolist(), keys.tolist()):
        held[i].add(k)
    matrix = np.zeros((len(rows), len(df)))
    matrix[text, at] = weights
    similar = 0
    for a in range(len(rows)):
        shared = np.minimum(matrix[a], matrix).sum(axis=1)
        found = shared >= 0.8 * (matrix[a].sum() + matrix.sum(axis=1) - shared)
        for b in np.flatnonzero(found)[np.flatnonzero(found) != a]:
            assert held[a] & held[int(b)]
            similar += 1
    assert similar > 200


def test_common_shingles_are_counted_exactly(spark):
    rows = [(i, f"all of us share this line {i} x{i % 7} y z q") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["df"] for r in common_shingles(frame, "text", share=0.5).collect()}
    assert got == {300}
    count = Counter(s for _, t in rows for s in shingle_bag(t))
    assert common_shingles(frame, "text", share=0.1).count() == sum(c >= 30 for c in count.values())


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    ids = np.sort(rng.choice(2**48, 400, replace=False)).astype(np.uint64)
    wa, wb = rng.random(400) + 0.1, rng.random(400) + 0.1
    wb[:200] = wa[:200]
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    zeros = np.zeros(400, int)
    _, a = band_keys(zeros, ids, wa.astype(np.float32), 2000, 1)
    _, b = band_keys(zeros, ids, wb.astype(np.float32), 2000, 1)
    assert abs((a == b).mean() - want) < 0.05


def test_shingles_equal_those_by_hand():
    texts = ["a b c d e f g a b c d e", "one Two", "ONE two", None, "", "x, y"]
    text, ids, times = shingles(pa.array(texts))
    assert Counter(text.tolist()) == {i: len(shingle_bag(t)) for i, t in enumerate(["a b c d e f g a b c d e", "one two", "one two", "", "", "x y"]) if t}
    assert sorted(times[text == 0].tolist()) == [1] * 6 + [2]
    assert ids[text == 1].tolist() == ids[text == 2].tolist() != ids[text == 5].tolist()


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 450)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert {r["node"]: r["root"] for r in got} == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_odd_rows(spark, odd, none):
    got = {(r["doc_id"], r["class_id"]) for r in digest_columns(odd).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3), (None, None), (5, 5), (6, 6), (7, 7)}
    kept = one_per_class(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 5, 6, 7]
    taken = odd.withColumnRenamed("key", "_least").withColumnRenamed("node", "_n")
    assert one_per_class(taken).count() == 6
    assert digest_columns(none).count() == 0 and one_per_class(none).count() == 0

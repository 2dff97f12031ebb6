"""Phrases against a plain count of every run of words."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from macrospark.llm import phrases
from macrospark.llm.phrases import grams_of


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score), by counting each run for itself."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        dropped = set()
        for longer, b in candidates.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    p = longer[i : i + k]
                    if 100 * b >= 80 * counts[p]:
                        dropped.add(p)
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), p, counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, " ".join(p), -a, left, right, n[lang], -score))
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in phrases.top_phrases(docs, **options).collect())


@pytest.mark.parametrize("passes", [1, 3])
def test_equals_brute_force(spark, passes):
    random.seed(passes)
    words = ["the", "of", "A", "b", "Cc", "dé", "|", "x-y", "e"]
    rows = []
    for _ in range(400):
        text = " ".join(random.choices(words, weights=[9, 7, 5, 4, 3, 2, 2, 1, 1], k=random.randint(0, 25)))
        text = text.replace("x-y", random.choice(["x-y,", "x-y \t ", "x-y\n"])) + random.choice(["", ". one two three four five six seven", "?"])
        rows.append((random.choice(["en", "de", None]), text))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    expected = brute(rows, 5, 40)
    assert len(expected) > 100
    assert found(docs, least=5, top=40, passes=passes) == expected


def test_odd_rows(odd, none, spark):
    rows = odd.withColumnRenamed("node", "lang")
    data = [(r["lang"], r["text"]) for r in rows.collect()]
    assert found(rows, least=2, top=50) == brute(data, 2, 50)
    assert phrases.top_phrases(none.withColumnRenamed("node", "lang")).count() == 0
    clash = rows.withColumnRenamed("key", "gram").withColumnRenamed("doc_id", "f")
    assert found(clash, least=2, top=50) == brute(data, 2, 50)


def test_paths_stand_for_the_edges(spark):
    """Chains, forks, rings and changes of weight: every edge is a run of one path, with its weight."""
    edges = []
    for lang, text, f in [("x", "a b c d e f g h i j k l m n", 7), ("x", "q r s t u", 3), ("x", "q r s v w", 2), ("y", "a b c d e f", 5), ("x", "o1 o2 o3 o4 o1 o2 o3", 4), ("x", "k l m n p p2 p3", 9)]:
        w = text.split()
        edges += [(lang, " ".join(w[i : i + 4]), f) for i in range(len(w) - 3)]
    edges = {(lang, g): f for lang, g, f in edges}
    frame = spark.createDataFrame([(*k, f) for k, f in edges.items()], "lang string, gram string, f long")
    for part in (1024, 3):
        rows = phrases.paths(frame, part).collect()
        runs = [(r["lang"], " ".join(r["words"][i : i + 4]), r["f"]) for r in rows for i in range(len(r["words"]) - 3)]
        assert sorted(runs) == sorted((*k, f) for k, f in edges.items())
    whole = {tuple(r["words"]) for r in phrases.paths(frame).collect()}
    assert tuple("a b c d e f".split()) in whole and len(whole) < len(edges)


def test_products_beyond_64_bits(spark):
    big = 5_000_000_000_000_000
    counted = spark.createDataFrame(
        [("x", 2, "a b", big), ("x", 1, "a", big + 3), ("x", 1, "b", big + 5), ("x", 0, "", 3 * big)],
        "lang string, size int, gram string, f long",
    )
    row = phrases.collocations(counted).first()
    assert row["score"] == 2_000_000 * big // (2 * big + 8)


def test_grams_of_a_slice_take_little_memory():
    rng = random.Random(8)
    texts = pa.array([" ".join(f"w{rng.randrange(5000)}" for _ in range(200)) for _ in range(2000)])
    tracemalloc.start()
    assert sum(len(grams) for number in range(3) for grams, _ in grams_of(texts, number, 3)) == 400_000
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 50 * texts.nbytes, most / texts.nbytes

import random

from macrospark.llm.licenses import LENGTHS, TEMPLATES, Library, bands_for, digest_columns, scan


def words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def grams(w):
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def brute(text):
    w, out = words(text), {}
    for name, template in TEMPLATES.items():
        t = words(template)
        length = next(x for x in LENGTHS if len(t) <= x)
        shares = [len(grams(w[i : i + 2 * length]) & grams(t)) / len(grams(t)) for i in range(0, max(len(w) - 2, 1), length)]
        if max(shares, default=0) >= 0.8:
            out[name] = max(shares)
    return out


def test_planted_notices_equal_brute_force(spark):
    rng = random.Random(1)
    filler = ["license", "under", "the", "software", "public", *(f"w{i}" for i in range(50))]
    docs = []
    for i in range(120):
        text = [rng.choice(filler) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.choice([0, 1, 2])):
            notice = rng.choice(list(TEMPLATES.values())).split()
            if rng.random() < 0.4:
                notice[rng.randrange(len(notice))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = notice
        docs.append((i, " ".join(text)))
    got = scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {r["doc_id"]: {x["name"]: x["containment"] for x in r["licenses"]} for r in got}
    assert found == {i: brute(t) for i, t in docs} and sum(map(len, found.values())) > 60


def test_bands_keep_the_promise(spark):
    library = Library(spark, TEMPLATES, 3, 0.8, 1e-4)
    assert all(2 <= library.bands[k] <= 120 for k in library.bands)
    similarity = 3 / (14 + 3 - 3)
    assert (1 - similarity) ** bands_for(8, 5, 3, 1.0, 1e-4) <= 1e-4


def test_odd_rows(spark, odd, none):
    rows = digest_columns(odd).collect()
    assert len(rows) == 10 and all(r["n_licenses"] == 0 and r["licenses"] == "" for r in rows)
    assert digest_columns(none).count() == 0
    taken = odd.withColumnRenamed("key", "licenses").withColumnRenamed("node", "_words")
    assert scan(taken).columns == [*taken.columns, "licenses_"]

import struct
from collections import Counter

import xxhash

from macrospark.llm.sharding import digest_columns, with_shard


def best(key, weights):
    """Rendezvous hashing by hand: the least -ln(u) / w."""
    import math

    first = xxhash.xxh64_intdigest(key.encode(), 42)
    scores = []
    for shard, weight in enumerate(weights):
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), first)
        scores.append((-math.log(((h >> 11) + 0.5) / 2**53) / weight, shard))
    return min(scores)[1]


def test_shards_equal_rendezvous_by_hand(spark):
    weights = [1.0, 2.0, 0.5, 4.0]
    rows = with_shard(spark.range(3000), "id", weights).collect()
    assert all(r["shard"] == best(str(r["id"]), weights) for r in rows)
    got = Counter(r["shard"] for r in rows)
    assert all(abs(got[s] / 3000 - w / 7.5) < 0.04 for s, w in enumerate(weights))


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "repeat('x', int(id % 7)) as text")
    rows = digest_columns(docs).collect()
    assert all(r["grown_shard"] in (r["shard"], 16) for r in rows)
    assert 0.03 < sum(r["grown_shard"] == 16 for r in rows) / 5000 < 0.09
    for shard in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_odd_rows(spark, odd, none):
    rows = digest_columns(odd).collect()
    assert len(rows) == 10
    null = [r for r in rows if r["doc_id"] == 3][0]
    assert (null["size"], null["text_crc32"]) == (1, 0)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert digest_columns(none).count() == 0
    assert with_shard(odd.withColumnRenamed("key", "shard"), "doc_id", [1.0]).columns[-1] == "shard_"

"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. *Weights.* A shingle (five words, A-Z lower-cased) weighs its occurrences in the text times
   `ln(1 + N / max(df, f * N))`, with N documents and `df` of them holding it: `f = COMMON` is
   the share of documents below which a shingle is no longer told apart by its frequency. The
   document frequencies that matter are exact and cover all documents: blocks of documents
   propose what is in half that share of them, with counts, and the shingles whose proposed
   counts add up to enough (four times mean shingles per document / f at most, which bounds what
   is broadcast) are counted exactly in a second pass.
2. *Samples.* Per sample k, a shingle's r, c ~ Gamma(2, 1) and beta ~ U(0, 1) come from its hash;
   with t = floor(ln w / r + beta), the shingle with the least ln c - r (t - beta + 1) is sampled
   together with t. Two texts agree in a sample with the probability of their weighted Jaccard
   similarity. `ROWS` samples make a band, `BANDS` bands a text's keys.
3. *Links.* In each bucket of texts that share a band key, the member that collides most is the
   hub, and all others are compared with it. Members of buckets in which some stay outside the
   hub's class are then put into smaller buckets, one for each set of one, two and three of their
   contested bands, with a hub drawn by hash for each; the more alike two texts are, the more of
   these they share. Only members outside the hub's class are compared, and this is repeated with
   other hubs `ROUNDS` times. That makes most classes whole with few comparisons, and decides
   nothing else: the texts of buckets that still hold several classes go through an exact join.
   Every comparison is exact weighted Jaccard on the whole texts.
4. *Rest.* Two texts of total weights W and V and similarity s share a weight of at least
   s / (1 + s) * (W + V). With all shingles in one order, rarest first, the first shingle they
   share is followed by at least that weight in both. So each text is put under its shingles up
   to there, once per class of total weight (steps of `STEP`) that a similar text can have, and
   pairs of different classes meet under the first shingle they share there. Bitmaps of their
   shingles bound what they can share; pairs that can be similar enough are compared. No pair of
   similar texts is left out.
5. *Classes.* Linked texts are joined into classes by star contraction.

Equal texts are one node from the start, so copies are never paired.

At similarity 0.8 a pair meets in some band with probability 1 - (1 - 0.8**3)**10 = 0.9992.

Defined cases: null and empty texts, and texts without any word, are alike only if equal; texts
of fewer than five words have one shingle of all their words; repeated rows share a class; an
empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from macrospark.llm.common import free_name, node_of, pieces, text_of, written
from macrospark.llm.components import components
from macrospark.llm.words import U, mix, shingles

SIMILARITY = 0.8
SHINGLE = 5
BANDS, ROWS = 10, 3
ROUNDS = 2
STEP = 1.05
COMMON = 0.01

EARLIER = 8
MAP = 8

_EVERYWHERE = 1 << 40
_BLOCK_DOCS = 2000
_BLOCK_SHINGLES = 4_000_000
_LEAST_DOCS = int(2 / COMMON)
_PIECE = 1_000_000
_DRAWS = 1 << 16


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of documents: how many, and the shingles of each, once per document."""
    docs, held, parts = 0, 0, []
    for batch in batches:
        for piece in pieces(batch, 0, _PIECE):
            parts.append(shingles(piece.column(0), size)[1])
            docs += piece.num_rows
            held += len(parts[-1])
            if docs >= _BLOCK_DOCS or (held >= _BLOCK_SHINGLES and docs >= _LEAST_DOCS):
                yield docs, np.concatenate(parts)
                docs, held, parts = 0, 0, []
    if docs:
        yield docs, np.concatenate(parts)


def common_shingles(docs: DataFrame, text: str, size: int = SHINGLE, share: float = COMMON) -> DataFrame:
    """Exact document frequencies of the shingles in at least `share` of all documents: (shingle, df, n).

    Rows are at most mean shingles per document / share.
    """
    texts = docs.select(text_of(text).alias("t"))
    n = texts.count()
    # A block proposes what is in half the share of its documents, with that count. What a shingle
    # has in blocks that do not propose it adds up to less than half the share of all documents,
    # so the proposed counts of a shingle that reaches the share add up to more than half of it.
    # Only the last block of a task can be so small that one document is half the share; it
    # proposes what is in two. While such blocks are few, they hide a quarter of the share at most.
    few = texts.rdd.getNumPartitions() <= share * n / 4

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs_in, found in _blocks(batches, size):
            ids, df = np.unique(found, return_counts=True)
            good = df >= (max(2, share * docs_in / 2) if few else share * docs_in)
            yield pa.RecordBatch.from_arrays([pa.array(ids[good].astype(np.int64)), pa.array(df[good].astype(np.int64))], names=["shingle", "df"])

    proposed = texts.mapInArrow(candidates, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df"))
    least = share * n / 4 if few else 0  # so 4 * mean shingles per document / share pass at most
    marked = np.sort(proposed.where(F.col("df") >= least).select("shingle").toPandas()["shingle"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(marked)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for _, found in _blocks(batches, size):
            found = found.astype(np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                ids, df = np.unique(found[known[at] == found], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(df.astype(np.int64))], names=["shingle", "df"])

    df = texts.mapInArrow(counts, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df"))
    df = written(df, "near-dedup-df")
    return df.where(F.col("df") >= F.lit(share * n)).withColumn("n", F.lit(n).cast("bigint"))


class Weights:
    """TF-IDF weights from the table of common shingles."""

    def __init__(self, n: int, ids: np.ndarray, df: np.ndarray, share: float):
        order = np.argsort(ids)
        self.ids = ids[order].astype(U)
        self.idf = np.log1p(n / df[order].astype(float)).astype(np.float32)
        self.rare = np.float32(np.log1p(1 / share))

    def _at(self, ids: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)

    def common(self, ids: np.ndarray) -> np.ndarray:
        """Which of the shingles are common."""
        return self.ids[self._at(ids)] == ids if len(self.ids) else np.zeros(len(ids), bool)

    def __call__(self, ids: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
        weights = np.full(len(ids), self.rare, np.float32)
        if len(self.ids):
            weights = np.where(self.common(ids), self.idf[self._at(ids)], weights)
        return weights * occurrences.astype(np.float32)


def learn_weights(docs: DataFrame, text: str, size: int = SHINGLE, share: float = COMMON) -> Weights:
    table = common_shingles(docs, text, size, share).toPandas()  # bounded, see common_shingles
    n = int(table["n"].iloc[0]) if len(table) else 1
    return Weights(n, table["shingle"].to_numpy(np.int64), table["df"].to_numpy(np.int64), share)


def _draws() -> tuple[np.ndarray, ...]:
    """Tables of 1/r, r, ln c and beta, drawn once with a fixed seed."""
    rng = np.random.default_rng(20180401)
    r, c = rng.gamma(2.0, 1.0, _DRAWS), rng.gamma(2.0, 1.0, _DRAWS)
    beta = rng.random(_DRAWS)
    return tuple(x.astype(np.float32) for x in (1 / r, r, np.log(c), beta))


_TABLES = _draws()


def band_keys(text: np.ndarray, ids: np.ndarray, weights: np.ndarray, bands: int, rows: int):
    """Consistent weighted samples of each text, `rows` to a band: the texts, and a key per band.

    `text` is sorted, and so are `ids` within a text; of equal minima the first one counts.
    """
    heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    member = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(text))))
    inverse, r, log_c, beta = _TABLES
    first, step = mix(ids), mix(ids ^ U(0x5DEECE66D)) | U(1)
    log_w = np.log(weights)
    keys = np.empty((len(heads), bands), np.int64)
    for band in range(bands):
        key = np.full(len(heads), band + 1, U)
        for row in range(rows):
            at = ((first + U(band * rows + row) * step) >> U(24)) & U(_DRAWS - 1)
            at = at.astype(np.int32)
            shift = beta[at]
            t = np.floor(log_w * inverse[at] + shift)
            cost = log_c[at] - r[at] * (t - shift + np.float32(1))
            least = np.minimum.reduceat(cost, heads)
            winners = np.flatnonzero(cost == least[member])
            winner = winners[np.searchsorted(winners, heads)]
            key = mix(key * U(0x9E3779B97F4A7C15) ^ ids[winner] ^ (t[winner].astype(np.int64).astype(U) << U(48)))
        keys[:, band] = key.astype(np.int64)
    return text[heads], keys


def band_rows(nodes: DataFrame, weights: Weights, size: int, bands: int, rows: int) -> DataFrame:
    """(key, node): the band keys of each text; texts without words have none."""
    shared = nodes.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("node", T.BinaryType())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                text, ids, occurrences = shingles(piece.column(0), size)
                if not len(text):
                    continue
                which, found = band_keys(text, ids, shared.value(ids, occurrences), bands, rows)
                node = piece.column(1).take(pa.array(np.repeat(which, bands)))
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), node], schema=pa.schema([("key", pa.int64()), ("node", pa.binary())]))

    return nodes.select("t", "node").mapInArrow(keys, schema)


def _similarities(a: pa.Array, b: pa.Array, weights: Weights, size: int) -> np.ndarray:
    """Exact weighted Jaccard similarity of texts, pair by pair."""
    n = len(a)
    ta, ia, oa = shingles(a, size)
    tb, ib, ob = shingles(b, size)
    wa, wb = weights(ia, oa).astype(float), weights(ib, ob).astype(float)
    ka, kb = (ta.astype(U) << U(48)) | ia, (tb.astype(U) << U(48)) | ib
    total = np.bincount(ta, wa, n) + np.bincount(tb, wb, n)
    if not len(ka) or not len(kb):
        return np.zeros(n)
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    both = kb[at] == ka
    shared = np.bincount(ta[both], np.minimum(wa[both], wb[at[both]]), n)
    return shared / np.maximum(total - shared, 1e-12)


def verified(pairs: DataFrame, texts: DataFrame, weights: Weights, size: int, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough, with their similarity."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)
    rows = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
        .select("ta", "tb", "a", "b")
    )
    schema = T.StructType(
        [T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("similarity", T.DoubleType())]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                found = _similarities(piece.column(0), piece.column(1), shared.value, size)
                good = np.flatnonzero(found >= least)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(2).take(pa.array(good)), piece.column(3).take(pa.array(good)), pa.array(found[good])],
                    schema=pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())]),
                )

    return rows.mapInArrow(compare, schema)


def _with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _band_sets(keys) -> Column:
    """Keys of all sets of one, two and three of a text's (at most `BANDS`) contested buckets."""
    n = F.size(keys)
    after = lambda i: F.slice(keys, i, n)
    pairs = F.flatten(F.transform(keys, lambda a, i: F.transform(after(i + 2), lambda b: F.xxhash64(a, b))))
    triples = F.flatten(
        F.flatten(
            F.transform(
                keys,
                lambda a, i: F.transform(
                    after(i + 2), lambda b, j: F.transform(after(i + j + 3), lambda c: F.xxhash64(a, b, c))
                ),
            )
        )
    )
    return F.concat(F.transform(keys, lambda a: F.xxhash64(a)), pairs, triples)


def _against_hubs(rows: DataFrame, hubs: DataFrame, can: Column | None = None) -> DataFrame:
    """Pairs (a, b) of each bucket's hub and its members of other classes that `can` be similar.

    `hubs` has the columns of `rows`, the key aside named `other_`.
    """
    meets = (rows["key"] == hubs["key"]) & (F.col("root") != F.col("other_root"))
    pairs = rows.join(hubs, meets if can is None else meets & can)
    return written(pairs.select(F.col("other_node").alias("a"), F.col("node").alias("b")).distinct(), "near-dedup-pairs")


def _other(rows: DataFrame) -> DataFrame:
    return rows.toDF(*[c if c == "key" else f"other_{c}" for c in rows.columns])


def _contested(members: DataFrame, first: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root): the members of buckets in which some stand outside the hub's class."""
    here = _with_roots(members, roots)
    hub_roots = _with_roots(first.where("n > 2").withColumnRenamed("hub", "node"), roots)
    outside = here.join(hub_roots.select("key", F.col("root").alias("hub_root")), "key").where(F.col("root") != F.col("hub_root"))
    return here.join(outside.select("key").distinct(), "key")


def _shared(texts: DataFrame, weights: Weights, size: int) -> DataFrame:
    """(node, held): the shingles of each text that another of these texts holds too, and how many hold them.

    Common shingles are not counted, so no shingle is counted in more than `share` of all documents.
    """
    known = texts.sparkSession.sparkContext.broadcast(weights)

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                text, ids, _ = shingles(piece.column(0), size)
                rare = np.flatnonzero(~known.value.common(ids))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(1).take(pa.array(text[rare])), pa.array(ids[rare].astype(np.int64))],
                    schema=pa.schema([("node", pa.binary()), ("id", pa.int64())]),
                )

    rows = texts.select("t", "node").mapInArrow(ids_of, "node binary, id long")
    rows = rows.withColumn("seen", F.count(F.lit(1)).over(W.partitionBy("id"))).where("seen > 1")
    return rows.groupBy("node").agg(F.collect_list(F.struct("id", "seen")).alias("held"))  # one text's, so bounded by its length


def _seen(text: np.ndarray, ids: np.ndarray, common: np.ndarray, held: pa.Array) -> np.ndarray:
    """How many texts hold each shingle, 1 if no other text does, and `_EVERYWHERE` for the common ones."""
    seen = np.where(common, _EVERYWHERE, 1)
    owner = pc.list_parent_indices(held).to_numpy(zero_copy_only=False).astype(U)
    entries = pc.list_flatten(held)
    id_of, n = (entries.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    seen[np.searchsorted((text.astype(U) << U(48)) | ids, (owner << U(48)) | id_of.astype(U))] = n
    return seen


def prefix_keys(text: np.ndarray, ids: np.ndarray, weights: np.ndarray, seen: np.ndarray, least: float):
    """Keys of which any two texts of similarity `least` share one: (text, key, keys before it, how many).

    `seen` grows with the number of texts that hold a shingle, and is 1 only for shingles of one
    text. Shingles are ordered by it, so that the keys are rare; those in one text are no keys.
    Of the keys before a key in the same order, the first `EARLIER` are given, one list after another.
    """
    order = np.lexsort((ids, seen, text))
    text, ids, weights, seen = text[order], ids[order], weights[order].astype(float), seen[order]
    heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    member = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(text))))
    total = np.add.reduceat(weights, heads)
    before = np.cumsum(weights) - weights
    rest = total[member] - (before - before[heads][member])  # from this shingle on
    level = np.floor(np.log(total) / np.log(STEP)).astype(np.int64)
    reach = int(np.ceil(np.log(1 / least) / np.log(STEP))) + 1
    slack = 1e-6  # for rounding; it only adds keys
    which, keys, earlier, counts = [], [], [], []
    for off in range(-reach, reach + 1):
        low = STEP ** (level + off).astype(float)
        fits = (low * STEP * (1 + slack) >= least * total) & (low * (1 - slack) <= total / least)
        need = least / (1 + least) * (total + np.maximum(low, least * total)) * (1 - slack)
        at = np.flatnonzero(fits[member] & (rest >= need[member]) & (seen > 1))
        if not len(at):
            continue
        pair = U(abs(off)) ^ ((level[member[at]] + min(off, 0)).astype(U) << U(8))
        found = mix(mix(pair) ^ mix(ids[at])).astype(np.int64)
        first = np.append(True, member[at][1:] != member[at][:-1])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        n = np.minimum(np.arange(len(at)) - begin, EARLIER)
        which.append(text[at])
        keys.append(found)
        counts.append(n)
        earlier.append(found[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])
    if not which:
        return (np.empty(0, np.int64),) * 4
    return np.concatenate(which), np.concatenate(keys), np.concatenate(earlier), np.concatenate(counts)


def _bitmaps(text: np.ndarray, ids: np.ndarray, chosen: np.ndarray, n: int) -> np.ndarray:
    """For each of n texts, `64 * MAP` bits in which those of its chosen shingles are set."""
    bits = np.zeros((n, MAP), U)
    spread = mix(ids[chosen] ^ U(0xB17))
    np.bitwise_or.at(bits, (text[chosen], (spread >> U(6)).astype(np.int64) % MAP), U(1) << (spread & U(63)))
    return bits.view(np.int64)


_MAPS = [f"{kind}{i}" for kind in "acr" for i in range(MAP)]
_SIGNATURE = ["total", "lone", *_MAPS]


def _signed(texts: DataFrame, weights: Weights, size: int) -> DataFrame:
    """The texts (t, node, held) with what bounds the weight they can share with another of them.

    `total` is the text's weight and `lone` that of the shingles no other text holds. Bitmaps tell
    which others it has: all (`a0`, …), those that weigh no less than a rare one (`r0`, …), and
    those that weigh less, but at least half of that (`c0`, …).
    """
    known = texts.sparkSession.sparkContext.broadcast(weights)
    schema = "t string, node binary, held array<struct<id: long, seen: long>>, total double, lone double, " + ", ".join(f"{m} long" for m in _MAPS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = known.value
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                text, ids, occurrences = shingles(piece.column(0), size)
                n, heavy = piece.num_rows, weigh(ids, occurrences)
                met = _seen(text, ids, weigh.common(ids), piece.column(2)) > 1
                total = np.bincount(text, heavy.astype(float), n)
                lone = np.bincount(text[~met], heavy[~met].astype(float), n)
                rare, half = heavy >= weigh.rare, heavy >= weigh.rare / 2
                bits = np.hstack([_bitmaps(text, ids, chosen, n) for chosen in (met, met & half & ~rare, met & rare)])
                columns = [*piece.columns, pa.array(total), pa.array(lone), *(pa.array(bits[:, i]) for i in range(len(_MAPS)))]
                yield pa.RecordBatch.from_arrays(columns, names=["t", "node", "held", *_SIGNATURE])

    return texts.select("t", "node", "held").mapInArrow(sign, schema)


def _can(rare: float, least: float) -> Column:
    """Whether a text and the `other_` one can be similar enough, by their signatures.

    What no other text holds is not shared, nor is a shingle whose bit the other text lacks.
    """
    need = least / (1 + least) * (1 - 1e-6) * (F.col("total") + F.col("other_total"))

    def lacking(kind: str, mine: str, other: str) -> Column:
        bits = [F.bit_count(F.col(f"{mine}{kind}{i}").bitwiseAND(F.bitwise_not(F.col(f"{other}a{i}")))) for i in range(MAP)]
        return sum(bits[1:], bits[0])

    def enough(mine: str, other: str) -> Column:
        lost = F.lit(rare) * lacking("r", mine, other) + F.lit(rare / 2) * lacking("c", mine, other)
        return F.col(f"{mine}total") - F.col(f"{mine}lone") * (1 - 1e-6) - lost >= need

    return enough("", "other_") & enough("other_", "")


def _prefixes(texts: DataFrame, weights: Weights, size: int, least: float) -> DataFrame:
    """Each text (with its signature) under the keys it shares with any text similar enough, and the first keys before the key."""
    known = texts.sparkSession.sparkContext.broadcast(weights)
    schema = "key long, node binary, root binary, before array<long>, " + ", ".join(f"{c} {t}" for c, t in texts.select(*_SIGNATURE).dtypes)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = known.value
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                text, ids, occurrences = shingles(piece.column(0), size)
                if not len(text):
                    continue
                seen = _seen(text, ids, weigh.common(ids), piece.column(3))
                which, found, earlier, counts = prefix_keys(text, ids, weigh(ids, occurrences), seen, least)
                at = pa.array(which)
                before = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(earlier, pa.int64()))
                columns = [pa.array(found, pa.int64()), piece.column(1).take(at), piece.column(2).take(at), before]
                columns += [piece.column(i).take(at) for i in range(4, piece.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "root", "before", *_SIGNATURE])

    return texts.select("t", "node", "root", "held", *_SIGNATURE).mapInArrow(keys, schema)


def _across(rows: DataFrame, can: Column) -> DataFrame:
    """The pairs (a, b) of different classes under one key that can be similar; rows as `_prefixes` makes them.

    The class with most rows under a key is met by the others, never by itself. Two texts meet at
    the first key they share, not again at later ones that have it among their earlier keys. Pairs
    that by their signatures cannot share enough are no pairs.
    """
    sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
    mixed = written(
        rows.join(most.where("roots > 1").select("key", F.col("most.root").alias("most")), "key"), "near-dedup-mixed"
    )
    others = _other(mixed.where("root <> most").drop("most"))
    meets = (
        (others["key"] == mixed["key"])
        & (F.col("root") != F.col("other_root"))
        & can
        & ~F.arrays_overlap("before", "other_before")
    )
    pairs = others.join(mixed.drop("most"), meets)
    return written(pairs.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct(), "near-dedup-pairs")


def links(members: DataFrame, texts: DataFrame, weights: Weights, size: int, least: float, rounds: int = ROUNDS) -> DataFrame:
    """(node, root) of the classes that all verified links among the members of buckets make."""
    first = members.groupBy("key").agg(F.max(F.struct("score", "node")).alias("h"), F.count(F.lit(1)).alias("n"))
    first = written(first.select("key", F.col("h.node").alias("hub"), "n"), "near-dedup-hubs")
    own = members.withColumn("root", F.col("node"))
    pairs = _against_hubs(own, _other(first.select("key", F.col("hub").alias("node"), F.col("hub").alias("root"))))
    edges = written(verified(pairs, texts, weights, size, least), "near-dedup-links")
    roots = components(edges, "a", "b")
    contested = written(_contested(members, first, roots), "near-dedup-contested")
    open_texts = texts.select("t", "node").join(contested.select("node").distinct(), "node")
    held = open_texts.join(_shared(open_texts, weights, size), "node", "left").withColumn("held", F.coalesce("held", F.array()))
    signed = written(_signed(held, weights, size), "near-dedup-signed")
    can = _can(float(weights.rare) * (1 - 1e-6), least)
    for number in range(rounds):
        if number:
            contested = _contested(members, first, roots)
        kept = contested.groupBy("node", "root").agg(F.array_sort(F.collect_set("key")).alias("keys"))  # BANDS at most
        kept = kept.join(signed.drop("t", "held"), "node")
        sets = written(kept.select("node", "root", F.explode(_band_sets(F.col("keys"))).alias("key"), *_SIGNATURE), "near-dedup-sets")
        drawn = sets.groupBy("key").agg(
            F.min_by(F.struct("node", "root", *_SIGNATURE), F.struct(F.xxhash64("node", "key", F.lit(number)), "node")).alias("h"),
            F.min("root").alias("low"), F.max("root").alias("high"),
        )
        hubs = _other(drawn.where("low <> high").select("key", "h.*"))
        found = written(verified(_against_hubs(sets, hubs, can), texts, weights, size, least), "near-dedup-links")
        if found.isEmpty():
            break
        edges = edges.unionByName(found)
        roots = components(edges, "a", "b")
    # What the hubs leave open: every pair of different classes that can be similar is compared.
    rest = _contested(members, first, roots).select("node", "root").distinct()
    prefixes = written(_prefixes(signed.join(rest, "node"), weights, size, least), "near-dedup-prefixes")
    pairs = _across(prefixes, can)
    found = written(verified(pairs, texts, weights, size, least), "near-dedup-links")
    return roots if found.isEmpty() else components(edges.unionByName(found), "a", "b")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    share: float = COMMON,
) -> DataFrame:
    """(node, class_id, class_size) for each distinct text; the class id is its least document key.

    `node_of(text)` gives a document's node.
    """
    weights = learn_weights(docs, text, size, share)
    nodes = docs.select(text_of(text).alias("t"), node_of(text).alias("node"))
    keyed = written(band_rows(nodes, weights, size, bands, rows), "near-dedup-bands")
    full = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key")
    members = written(keyed.join(full, "key").distinct(), "near-dedup-members")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    scores = members.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("score"))
    members = written(members.join(scores, "node"), "near-dedup-members")
    wanted = members.select("node").distinct()
    texts = written(nodes.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "near-dedup-texts")
    roots = links(members, texts, weights, size, similarity)
    counted = docs.groupBy(node_of(text).alias("node")).agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"))).alias("first"), F.count(F.lit(1)).alias("n"))
    rooted = written(_with_roots(counted, roots), "near-dedup-nodes")
    classes = rooted.groupBy("root").agg(F.min("first").alias("least"), F.sum("n").alias("class_size"))
    return rooted.join(classes, "root").select("node", F.col("least.id").alias("class_id"), "class_size")


def digest_columns(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its key, its class, the class's size, and whether it is the one to keep."""
    classes = near_duplicates(docs, key, text, **options)
    return (
        docs.select(F.col(key), node_of(text).alias("node"))
        .join(classes, "node")
        .select(key, "class_id", "class_size", F.col(key).eqNullSafe(F.col("class_id")).alias("first"))
    )


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without near-duplicates: of each class one row with the least key stays."""
    node, least = free_name(docs, "_node"), free_name(docs, "_least")
    classes = near_duplicates(docs, key, text, **options)
    classes = classes.select(F.col("node").alias(node), F.col("class_id").alias(least))
    first = docs.withColumn(node, node_of(text)).join(classes, node).where(F.col(key).eqNullSafe(F.col(least)))
    # Equal rows, and rows of one key with different texts, may still be several.
    spare = free_name(docs, "_n")
    order = W.partitionBy(least).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in docs.columns])
    return first.withColumn(spare, F.row_number().over(order)).where(F.col(spare) == 1).select(*docs.columns)

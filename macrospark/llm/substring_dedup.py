"""Removal of repeated byte strings, found with suffix arrays.

A text is its UTF-8 bytes; a window is `length` consecutive bytes of one document. Every byte of
a window that also starts earlier (in a document with a smaller key, or before it in the same
one) is removed.

1. *Anchors.* Each window has an anchor: the `GRAM` bytes in it with the least hash, the first of
   equals. Equal windows have equal anchors at the same distance from their beginning. Windows
   are put into two halves by that distance, and the bytes that all windows of a half hold around
   an anchor, its core, make their key: only windows with one key need be compared. A segment is
   the text under a run of windows with one anchor and half.
2. *Candidates.* Keys that occur more than once are kept. Which they are is counted over all
   documents; the keys travel to the segments if they are few (`BROADCAST_KEYS`), beyond it the
   segments' places, without their bytes, are shuffled to them, and the places that stay to their
   texts. Copies of a whole text are represented by the first.
3. *Order.* Equal segments are combined first. The different segments of a key go into one
   block, the blocks' suffixes are ranked by `suffix_array` to a depth of `length` bytes, and those
   of one rank are one class, whose first place is known. A key with more than
   `CROWD` different segments is split: its windows are cut into bins by their distance from the
   anchor, and the core of a bin joins the key; bins of `SPLITS` windows, and of one window in the
   end, where each key has a single segment. So no block holds more than `CROWD` segments, nothing
   is dropped, and rows grow with the windows of crowded keys only.
4. *Removal.* Of each document the places that are not first are merged and cut out.

Many rows name their document. They do it by its key; the digest of its text, its mark, goes along
only where several texts share a key or the key is null.

Defined cases: null is the empty text; documents of equal key are told apart by their text, and
repeated rows of one key and text are one document; a null key is the smallest; texts shorter
than `length` stay whole; an empty table gives an empty result; extra columns are not read.
Kept bytes may cut a character in two, so they are returned as binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.llm.common import node_of, pieces, text_of, written
from macrospark.llm.suffix_array import prefix_ranks
from macrospark.llm.words import U, mix, utf8

LENGTH = 100
GRAM = 36
CROWD = 2000
SPLITS = (8, 1)
BROADCAST_KEYS = 4_000_000
BROADCAST_NODES = 1_000_000

_PIECE = 1_000_000
_BLOCK = 500_000
_PLACE_BITS = 26
_SIZE_BITS = 27  # of a span, whose beginning has the other 36
_ODD = 0xD1342543DE82EF95
_INVERSE = pow(_ODD, -1, 1 << 64)


def width_of(length: int, gram: int) -> int:
    """Places that an anchor can have in a window."""
    return length - gram + 1


def anchors(data: np.ndarray, at: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor and half: text number, first window, windows, distance of the
    first window from the anchor, and hash of the core.

    Places are counted within the text. `data` must have fewer than 2**26 bytes.
    """
    half = -(-width_of(length, gram) // 2)
    n, width = len(data), width_of(length, gram)
    windows = n - length + 1
    none = np.empty(0, np.int64)
    if windows < 1:
        return none, none, none, none, none
    powers = np.full(n + 1, _ODD, U)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(n + 1, _INVERSE, U)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(n + 1, U)
    np.cumsum(mix(data.astype(U) + U(1)) * powers[:n], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    # The least of `width` consecutive grams, by doubling; the place in the low bits breaks ties.
    low = U((1 << _PLACE_BITS) - 1)
    least, span = (grams & ~low) | np.arange(len(grams), dtype=U), 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    place = (least & low).astype(np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[:windows]
    inside = np.arange(windows) + length <= at[1:][text]
    begins = inside.copy()
    begins[1:] &= (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.flatnonzero(begins)
    stops = np.append(np.flatnonzero(begins | ~inside), windows)
    end = stops[np.searchsorted(stops, first, "right")]
    spot = place[first]
    lead, last = spot - first, spot - end + 1  # distances of the first and the last window
    low, high = last // half, lead // half
    pieces_of = high - low + 1
    run = np.repeat(np.arange(len(first)), pieces_of)
    bin_of = high[run] - (np.arange(len(run)) - np.repeat(np.cumsum(pieces_of) - pieces_of, pieces_of))
    far, near = np.minimum(lead[run], bin_of * half + half - 1), np.maximum(last[run], bin_of * half)
    core = spot[run] - bin_of * half
    hashes = (sums[core + length - half + 1] - sums[core]) * inverse[core]
    keys = mix(mix(hashes) ^ (bin_of.astype(U) + U(1))).view(np.int64)
    of = text[first][run]
    return of, spot[run] - far - at[:-1][of], far - near + 1, far, keys


def _parts(batch: pa.RecordBatch, length: int, gram: int):
    """Slices of a batch; a text too long for one slice is cut, windows staying whole."""
    for piece in pieces(batch, 0, _PIECE):
        data, at = utf8(piece.column(0))
        limit = (1 << _PLACE_BITS) - 1
        if len(data) <= limit:
            yield piece, data, 0, anchors(data, at, length, gram)
            continue
        step = limit - length  # one very long text
        for base in range(0, len(data), step):
            part = data[base : base + step + length - 1]
            yield piece, part, base, anchors(part, np.array([0, len(part)]), length, gram)


def _repeated(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Keys that occur more than once."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [keys for _, _, _, (_, _, _, _, keys) in _parts(batch, length, gram)]
            keys, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], names=["key", "times"])

    found = texts.select("t").mapInArrow(counts, "key long, times long").groupBy("key").agg(F.sum("times").alias("times"))
    return written(found.where("times > 1").select("key"), "substring-keys")


def _place_fields(texts: DataFrame) -> list[T.StructField]:
    """Of a run of windows; `lead` is the distance of its first window from the anchor."""
    return [
        T.StructField("key", T.LongType()),
        T.StructField("lead", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("windows", T.IntegerType()),
        T.StructField("id", texts.schema["id"].dataType),
        T.StructField("mark", T.BinaryType()),
    ]


def _bytes_at(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes from each `begin` on, as many as its size."""
    ends = np.append(0, np.cumsum(sizes))
    # all one after another: each byte's place is its segment's beginning plus its offset
    index = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[index])])


def _segments(texts: DataFrame, length: int, gram: int, with_bytes: bool = True) -> DataFrame:
    """Each run of windows, and the text under it."""
    schema = T.StructType(_place_fields(texts) + [T.StructField("segment", T.BinaryType())] * with_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, base, (of, first, count, lead, key) in _parts(batch, length, gram):
                _, at = utf8(piece.column(0))
                begin = first + at[:-1][of] if not base and len(at) > 2 else first
                rows = pa.array(of)
                columns = [
                    pa.array(key), pa.array(lead.astype(np.int32)), pa.array(first + base),
                    pa.array(count.astype(np.int32)), piece.column(2).take(rows), piece.column(1).take(rows),
                ]
                if with_bytes:
                    columns.append(_bytes_at(data, begin, count + length - 1))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.select("t", "mark", "id").mapInArrow(cut, schema)


def _segments_at(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """The text under given runs of windows: each text travels once, not each of its overlapping segments."""
    schema = T.StructType([*_place_fields(texts), T.StructField("segment", T.BinaryType())])
    step = max(1, (1 << 23) // length)  # a segment has less than two windows' bytes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                data, at = utf8(piece.column(0))
                lists = piece.column(3)
                flat = lists.flatten()
                of = np.repeat(np.arange(len(at) - 1), pc.list_value_length(lists).to_numpy())
                key, lead, start, windows = (pc.struct_field(flat, i) for i in range(4))
                begin, sizes = at[:-1][of] + start.to_numpy(), windows.to_numpy() + (length - 1)
                for low in range(0, len(of), step):
                    some = slice(low, low + step)
                    rows = pa.array(of[some])
                    yield pa.RecordBatch.from_arrays(
                        [
                            key[some], lead[some], start[some], windows[some], piece.column(2).take(rows),
                            piece.column(1).take(rows), _bytes_at(data, begin[some], sizes[some]),
                        ],
                        names=schema.names,
                    )

    doc = F.struct("id", "mark").alias("doc")
    # A document whose row is repeated names its places more often, and its text comes as often.
    of_text = places.groupBy(doc).agg(F.collect_set(F.struct("key", "lead", "start", "windows")).alias("places"))
    return texts.select("t", "mark", "id", doc).join(of_text, "doc").select("t", "mark", "id", "places").mapInArrow(cut, schema)


def _class_runs(block: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Rank the windows of a block's segments; for each segment, runs of windows with their first places."""
    data, at = utf8(block.column("segment"))
    n, lengths = block.num_rows, np.diff(at)
    sizes = lengths + 1
    begin = np.append(0, np.cumsum(sizes))[:-1]
    symbols = np.zeros(len(data) + n, np.int64)  # 0 separates
    symbols[np.arange(len(data)) + np.repeat(np.arange(n), lengths)] = data.astype(np.int64) + 1
    rank = prefix_ranks(symbols, length)
    member = np.repeat(np.arange(n), sizes)
    offset = np.arange(len(symbols)) - begin[member]
    valid = np.flatnonzero(offset + length < sizes[member])
    of, offset, kind = member[valid], offset[valid], rank[valid]
    # Places: the rank of the document, then the start within it.
    named = list(zip(block.column("id").to_pylist(), block.column("mark").to_pylist()))
    documents = {d: i for i, d in enumerate(named)}
    ordered = sorted(documents, key=lambda d: (d[0] is not None, 0 if d[0] is None else d[0], d[1] or b""))
    ranks = {d: i for i, d in enumerate(ordered)}
    start = block.column("start").to_numpy()
    place = (np.array([ranks[d] for d in named], np.int64) << 36)[of] + start[of] + offset
    least = np.full(len(symbols) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, kind, place)
    first = least[kind]
    heads = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (first[1:] != first[:-1] + 1))[: len(of)])
    runs = np.diff(np.append(heads, len(of)))
    moved = (block.column("times").to_numpy()[of[heads]] > 1) | (first[heads] != place[heads])
    heads, runs = heads[moved], runs[moved]
    rows = pa.array(of[heads])
    holder = pa.array(np.array([documents[d] for d in ordered], np.int64)[first[heads] >> 36])
    return pa.RecordBatch.from_arrays(
        [
            block.column("key").take(rows), block.column("digest").take(rows), pa.array(offset[heads].astype(np.int32)),
            pa.array(runs.astype(np.int32)), block.column("id").take(holder), block.column("mark").take(holder),
            pa.array(first[heads] & ((1 << 36) - 1)),
        ],
        names=["key", "digest", "skip", "run", "first_id", "first_mark", "first_start"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their keys, cut between keys into blocks of about `_BLOCK` bytes."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        keys = batch.column("key").to_numpy()
        sizes = pc.binary_length(batch.column("segment")).to_numpy()
        start = 0
        for head in np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)).tolist():
            if size >= _BLOCK and keys[start] != last:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(batch.slice(start, head - start))
            size += int(sizes[start:head].sum())
            start, last = head, keys[head - 1]
    if held:
        yield pa.concat_batches(held)


def _sorted_runs(segments: DataFrame, length: int) -> DataFrame:
    """Class runs of all segments whose key has several."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batch for batch in batches if batch.num_rows):
            yield _class_runs(block, length)

    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("digest", T.LongType()),
            T.StructField("skip", T.IntegerType()),
            T.StructField("run", T.IntegerType()),
            T.StructField("first_id", segments.schema["id"].dataType),
            T.StructField("first_mark", T.BinaryType()),
            T.StructField("first_start", T.LongType()),
        ]
    )
    return segments.repartition("key").sortWithinPartitions("key").mapInArrow(ranked, schema)


def _split(rows: DataFrame, bin_size: int, length: int) -> DataFrame:
    """Cut segments into bins of windows by their distance from the anchor; a bin's core joins the key."""
    lowest = F.col("lead") - F.col("windows") + 1  # the anchor's distance in the last window
    bins = F.sequence(F.floor(lowest / bin_size), F.floor(F.col("lead") / bin_size))
    high = F.least(F.col("lead"), F.col("bin") * bin_size + bin_size - 1)
    low = F.greatest(lowest, F.col("bin") * bin_size)
    skip = (F.col("lead") - high).cast("int")
    count = (high - low + 1).cast("int")
    segment = F.expr(f"substring(segment, cut_skip + 1, cut_windows + {length - 1})")
    # All windows of a bin hold the bytes from the last one's beginning to the first one's end.
    core = F.expr(f"substring(segment, int(lead - bin * {bin_size} + 1), {length - bin_size + 1})")
    return (
        rows.withColumn("bin", F.explode(bins))
        .withColumn("cut_skip", skip)
        .withColumn("cut_windows", count)
        .select(
            F.xxhash64("key", core, "bin").alias("key"),
            (F.col("lead") - F.col("cut_skip")).alias("lead"),
            (F.col("start") + F.col("cut_skip")).alias("start"),
            F.col("cut_windows").alias("windows"),
            "id",
            "mark",
            segment.alias("segment"),
        )
    )


def _repeats(rows: DataFrame, length: int, crowd: int, splits: tuple[int, ...], broadcast_keys: int) -> DataFrame:
    """(doc, span): bytes under windows that are not at their first place; beginning and size in one number."""
    place = F.struct("id", "mark", "start")  # nulls come first
    out = []
    for bin_size in (*splits, None):
        rows = rows.withColumn("digest", F.xxhash64("segment"))
        kinds = rows.groupBy("key", "digest").agg(
            F.min(place).alias("p"), F.min("windows").alias("windows"), F.count(F.lit(1)).alias("times")
        )
        kinds = written(kinds, "substring-kinds", "zstd")
        counts = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("all_times"))
        counts = written(counts.where("all_times > 1").drop("all_times"), "substring-counts")
        crowded = F.col("kinds") > crowd if bin_size else F.lit(False)
        single = kinds.where("times > 1").join(counts.where("kinds = 1"), "key").select(
            "key", "digest", F.lit(0).alias("skip"), F.col("windows").alias("run"),
            F.col("p.id").alias("first_id"), F.col("p.mark").alias("first_mark"), F.col("p.start").alias("first_start"),
        )
        # Bytes travel for keys with several kinds only.
        mixed_keys = counts.where((F.col("kinds") > 1) & ~crowded).select("key")
        few = mixed_keys.limit(broadcast_keys + 1).count() <= broadcast_keys
        bytes_of = rows.join(F.broadcast(mixed_keys) if few else mixed_keys, "key").groupBy("key", "digest").agg(
            F.min(place).alias("p"), F.first("segment").alias("segment"), F.count(F.lit(1)).alias("times")
        )
        several = bytes_of.select("key", "digest", "segment", "times", "p.*")
        runs = written(single.unionByName(_sorted_runs(several, length)), "substring-runs", "zstd")
        here = rows.select("key", "digest", "id", "mark", "start").join(runs, ["key", "digest"])
        begin = F.col("start") + F.col("skip")
        same = F.col("first_id").eqNullSafe(F.col("id")) & F.col("first_mark").eqNullSafe(F.col("mark"))
        moved = here.where(~same | (F.col("first_start") != begin))
        out.append(moved.select(F.struct("id", "mark").alias("doc"), (F.shiftleft(begin, _SIZE_BITS) + F.col("run") + (length - 1)).alias("span")))
        if bin_size is None:
            break
        # Each has over `crowd` kinds, so they are few: the rows of all other keys need not move to find them.
        tight = counts.where(crowded).select("key")
        many = tight.limit(broadcast_keys + 1).count()
        if not many:
            break
        tight = F.broadcast(tight) if many <= broadcast_keys else tight
        rows = written(_split(rows.join(tight, "key"), bin_size, length), "substring-split", "zstd")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


_CUT = T.StructType(
    [
        T.StructField("node", T.BinaryType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def _cut_out(texts: DataFrame) -> DataFrame:
    """Merge each text's repeated places and take them out."""
    names = pa.schema([("node", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _PIECE):
                data, at = utf8(piece.column(0))
                spans = piece.column(2)
                base = np.repeat(at[:-1], pc.list_value_length(spans).to_numpy())
                packed = spans.flatten().to_numpy()
                start, size = packed >> _SIZE_BITS, packed & ((1 << _SIZE_BITS) - 1)
                edges = np.zeros(len(data) + 1, np.int32)
                np.add.at(edges, base + start, 1)
                np.add.at(edges, base + start + size, -1)
                gone = np.cumsum(edges[:-1]) > 0
                heads = gone.copy()
                heads[1:] &= ~gone[:-1]
                heads[at[:-1]] = gone[at[:-1]]  # no text here is empty
                lost, begun = (np.append(0, np.cumsum(x))[at] for x in (gone, heads))
                kept = [None, pa.py_buffer((at - lost).astype(np.int32)), pa.py_buffer(data[~gone])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(1), pa.array(np.diff(lost)), pa.array(np.diff(begun)), pa.Array.from_buffers(pa.binary(), len(at) - 1, kept)],
                    schema=names,
                )

    return texts.mapInArrow(cut, _CUT)


def dedup_substrings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    crowd: int = CROWD,
    splits: tuple[int, ...] = SPLITS,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, and a struct of what is kept.

    `kept` is the binary of the bytes that stay, null where the whole text stays.
    """
    if not 0 < gram <= length or (splits and max(splits) > length):
        raise ValueError("gram and bins must fit into a window")
    texts = docs.select(text_of(text).alias("t"), node_of(text).alias("node"), F.col(key).alias("id"))
    least = texts.groupBy("node").agg(
        F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("owner"), F.count(F.lit(1)).alias("copies")
    )
    least = written(least, "substring-owners")
    # Only the first of several copies is searched.
    copied = least.where("copies > 1").select("node", F.col("owner.id").alias("first"), F.lit(True).alias("copied"))
    few = copied.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    long = texts.where(F.octet_length("t") >= length).join(F.broadcast(copied) if few else copied, "node", "left")
    long = long.where(F.col("copied").isNull() | F.col("id").eqNullSafe(F.col("first"))).select("t", "node", "id")
    shared = least.groupBy("owner.id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    shared = written(shared.select("id", F.lit(True).alias("shared")), "substring-shared")
    few = shared.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    mark = F.when(F.col("id").isNull() | F.col("shared"), F.col("node")).alias("mark")
    long = long.join(F.broadcast(shared) if few else shared, "id", "left").select("t", "node", "id", mark)
    repeated = _repeated(long, length, gram)
    few = repeated.limit(broadcast_keys + 1).count() <= broadcast_keys
    if few:
        found = _segments(long, length, gram).join(F.broadcast(repeated), "key")
    else:
        places = _segments(long, length, gram, with_bytes=False).join(repeated, "key")
        found = _segments_at(long, written(places, "substring-places", "zstd"), length)
    rows = written(found, "substring-rows", "zstd")
    spans = _repeats(rows, length, crowd, splits, broadcast_keys).groupBy("doc").agg(F.collect_set("span").alias("spans"))
    spans = written(spans, "substring-spans", "zstd")  # one text's, so bounded by its length
    affected = spans.select("doc")
    few = affected.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    touched = long.select("t", "node", F.struct("id", "mark").alias("doc"))
    touched = touched.join(F.broadcast(affected) if few else affected, "doc", "left_semi").dropDuplicates(["doc"])
    touched = touched.join(spans, "doc").select("t", "node", "spans")
    cut = written(_cut_out(touched), "substring-cut", "zstd")

    rows = texts.select("id", "node", F.octet_length("t").cast("long").alias("n_bytes"), F.sha2(F.col("t").cast("binary"), 256).alias("whole"))
    joined = rows.join(least.select("node", "owner"), "node").join(cut, "node", "left")
    own = F.col("id").eqNullSafe(F.col("owner.id"))
    copy = ~own & (F.col("n_bytes") >= length)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        F.col("id").alias(key),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, empty).when(F.col("kept").isNull(), F.col("whole")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )


def digest_columns(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, bytes, bytes and runs removed, and the digest of what stays."""
    return dedup_substrings(docs).drop("kept")

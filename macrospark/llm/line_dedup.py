"""Line deduplication by winnowing: runs of lines that occur earlier are deleted.

A text is a sequence of line hashes, and `gram` consecutive lines make a gram. Of the grams of
each window the least is selected (the first of equals); windows are the runs that count: `run`
lines, or fewer that hold `words` words. What a window selects depends on nothing but its lines,
so every run that occurs twice is selected at the same of its grams in both places: the
fingerprint is guaranteed. Neighbouring windows mostly select the same gram, and only selected
positions become rows, each once, with how far its windows reach to the left and to the right
and the hash of the lines they reach over.

Fingerprints that stand at one position only are dropped. The others are joined with their
positions, and only these are extended both ways: over each of their windows, to the first place
whose lines on both sides are the same. A line in a run that begins earlier (in a document with a
smaller key, or in the same one) is deleted; overlapping runs make up the whole passage.

The first place of a run is a minimum that is combined before its shuffle, and the joins are
split by adaptive execution, so a passage in a third of all documents makes no task heavy;
rows grow with the selected positions, never with pairs.

Defined cases: null and empty texts have one empty line; texts of fewer than `RUN` lines stay as
they are unless `words` is given; a word is what stands between white space; lines are compared
exactly as they stand; documents of equal key are told apart by their text, and repeated rows of
one key and text are one document; a null key is the smallest; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.llm.common import node_of, pieces, ready, text_of, written

RUN = 3
GRAM = 1
WORDS = 50
#: Texts are hashed in slices of about so many bytes.
_SLICE = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)

_REACH = pa.struct([("left", pa.int32()), ("lines", pa.int32()), ("extent", pa.binary())])


def _selected(texts: list[bytes], run: int, gram: int, words: int | None) -> tuple[np.ndarray, ...]:
    """What the windows of some texts select.

    Per selected position: its text, its line there and its fingerprint; then, per window and in
    the order of the positions: the position's index, lines to the left, lines, hash of the lines.
    """
    split = [text.split(b"\n") for text in texts]
    sizes = np.array([len(lines) for lines in split])
    owner = np.repeat(np.arange(len(texts)), sizes)
    first_line = np.cumsum(sizes) - sizes
    digests = b"".join([md5(line).digest() for lines in split for line in lines])
    hashes = np.frombuffer(digests, dtype="<u8")[::2]
    held = None
    if words is not None:  # words ahead of each line
        counts = [len(line.split()) for lines in split for line in lines]
        held = np.concatenate([[0], np.cumsum(counts)])
    parts = []
    for lines in range(1 if words is not None else run, run + 1):
        starts = np.arange(len(hashes) - lines + 1)
        starts = starts[owner[starts] == owner[starts + lines - 1]]
        if lines < run:
            starts = starts[held[starts + lines] - held[starts] >= words]
        width = min(gram, lines)
        grams = hashes[: max(len(hashes) - width + 1, 0)].copy()
        for j in range(1, width):
            grams = grams * _MIX + hashes[j : len(grams) + j]
        least, left = grams[starts], np.zeros(len(starts), dtype=np.int64)
        for j in range(1, lines - width + 1):
            smaller = grams[starts + j] < least
            least = np.where(smaller, grams[starts + j], least)
            left[smaller] = j
        parts.append((starts + left, np.full(len(starts), width), least, left, np.full(len(starts), lines)))
    position, width, least, left, lines = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((lines, left, width, position))
    position, width, least, left, lines = (c[order] for c in (position, width, least, left, lines))
    opens = np.ones(len(position), dtype=bool)
    opens[1:] = (position[1:] != position[:-1]) | (width[1:] != width[:-1])
    at = position[opens]
    view = memoryview(digests)
    begins = (position - left).tolist()
    extents = [md5(view[16 * b : 16 * (b + n)]).digest() for b, n in zip(begins, lines.tolist())]
    return owner[at], at - first_line[owner[at]], least[opens].view(np.int64), np.cumsum(opens) - 1, left, lines, extents


def selected_positions(docs: DataFrame, key: str, text: str, run: int, gram: int, words: int | None) -> DataFrame:
    """(key, node, line, fingerprint, windows): one row per selected position; `node` stands for the text."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), node_of(text).alias("node"), text_of(text).cast("binary").alias("text"))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 2, _SLICE):
                texts, line, fingerprint, index, left, lines, extents = _selected(
                    piece.column(2).to_pylist(), run, gram, words
                )
                reach = pa.StructArray.from_arrays(
                    [pa.array(left, pa.int32()), pa.array(lines, pa.int32()), pa.array(extents, pa.binary())],
                    fields=list(_REACH),
                )
                bounds = np.searchsorted(index, np.arange(len(texts) + 1)).astype(np.int32)
                take = pa.array(texts, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(take),
                        piece.column(1).take(take),
                        pa.array(line, pa.int32()),
                        pa.array(fingerprint, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), reach),
                    ],
                    names=["key", "node", "line", "fingerprint", "windows"],
                )

    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("node", T.BinaryType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("fingerprint", T.LongType()),
            T.StructField("windows", T.ArrayType(T.StructType.fromDDL("left INT, lines INT, extent BINARY"))),
        ]
    )
    return rows.mapInArrow(select, schema)


def repeated_runs(
    docs: DataFrame, key: str, text: str, run: int = RUN, gram: int = GRAM, words: int | None = None
) -> DataFrame:
    """(key, node, start, lines): runs that occur earlier; `node` stands for the text."""
    if not 0 < gram <= run:
        raise ValueError("a gram must fit into a run")
    positions = written(selected_positions(docs, key, text, run, gram, words), "line-dedup-positions")
    known = F.col("key").isNotNull().alias("known")
    here = F.struct(known, "key", "node", "line")
    several = (
        positions.groupBy("fingerprint")
        .agg(F.min(here).alias("low"), F.max(here).alias("high"))
        .where("low <> high")
        .select("fingerprint")
    )
    # Extend: each window to the left and right of a repeated fingerprint, to the first place of the same lines.
    reached = positions.join(several, "fingerprint").select("key", "node", "line", F.explode("windows").alias("w"))
    reached = reached.select("key", "node", (F.col("line") - F.col("w.left")).alias("start"), "w.lines", "w.extent")
    place = F.struct(known, "key", "node", "start")
    first = reached.groupBy("extent").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    later = reached.join(first.where("first <> last").drop("last"), "extent")
    return later.where(place > F.col("first")).select("key", "node", "start", "lines")


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN, gram: int = GRAM, words: int | None = None
) -> DataFrame:
    """Per distinct (key, text): the lines, how many were deleted, and the text that is left.

    `words` is how many words make a run of fewer than `run` lines count; without it none counts.
    """
    found = repeated_runs(docs, key, text, run, gram, words)
    starts = found.groupBy("key", "node").agg(
        F.sort_array(F.collect_set(F.struct("start", "lines"))).alias("starts")  # one document's, so bounded by its lines
    )
    rows = docs.select(F.col(key).alias("k"), node_of(text).alias("n"), text_of(text).alias("t"))
    joined = rows.join(starts, F.col("k").eqNullSafe(F.col("key")) & (F.col("n") == F.col("node")), "left")
    lines = F.split("t", "\n")
    # A line is deleted if it is one of the lines of a run that begins at it or before it.
    covered = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s["start"], s["start"] + s["lines"] - 1)))
    )
    kept = F.when(F.col("starts").isNull(), F.col("t")).otherwise(
        F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered")),
                lambda i: F.element_at(F.col("lines"), i + 1),
            ),
            "\n",
        )
    )
    return joined.withColumn("covered", covered).withColumn("lines", lines).select(
        F.col("k").alias(key),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("starts").isNull(), F.lit(0)).otherwise(F.size("covered")).cast("long").alias("n_removed"),
        kept.alias("kept_text"),
    )


def digest_columns(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, lines, lines deleted, and the digest of the text that is left.

    Runs of `RUN` lines count, and shorter ones of `WORDS` words.
    """
    return dedup_lines(docs, words=WORDS).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )

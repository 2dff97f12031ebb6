"""Benchmark decontamination: a Wu-Manber search for all windows of all test strings at once.

The alphabet is words. A window is `window` consecutive words of an item; an item with fewer
words, but not none, is one window. For each window length `m` there is a table of blocks of
`b` words: a block's shift is its distance from the end of the nearest window that holds it, and
`m - b + 1` if no window does, so that most positions are skipped. A block with shift 0 ends a
window; the windows that end so are its bucket, and each is compared directly.

Items travel as broadcast blocks of at most `BLOCK_BYTES` of text. One pass over the documents
serves one block; with more items, passes follow one another inside the same tasks, each adding
its hits, so no document is shuffled and no item is left out.

Defined cases: null and empty texts have no words; an item without words matches nothing; a
repeated item counts once; a null item id reads as the empty string; repeated documents are each
judged; all columns pass through, and a result column whose name is taken gets `_` appended.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.llm.common import free_name

WINDOW = 10
BLOCK_BYTES = 1_000_000
_LONGEST_BLOCK = 3

_SPAN = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(_SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)

# Words are runs of 0-9, a-z after lower-casing A-Z, and every byte of a non-ASCII character.
_WORDS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_WORDS).split() if text else []


class Matcher:
    """All windows of one length, searched together."""

    def __init__(self, length: int, windows: dict[tuple[int, ...], set[str]]):
        self.length, self.block = length, min(_LONGEST_BLOCK, length)
        self.skip = length - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], list[tuple[tuple[int, ...], set[str]]]] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                at = window[end - self.block : end]
                self.shift[at] = min(self.shift.get(at, self.skip), length - end)
            self.buckets.setdefault(window[-self.block :], []).append((window, items))

    def search(self, text: list[int]) -> Iterator[tuple[int, set[str]]]:
        """The end of each occurrence, and the items it belongs to."""
        length, block, skip, shift = self.length, self.block, self.skip, self.shift
        end, n = length, len(text)
        while end <= n:
            at = tuple(text[end - block : end])
            step = shift.get(at, skip)
            if step:
                end += step
                continue
            here = tuple(text[end - length : end])
            for window, items in self.buckets[at]:
                if window == here:
                    yield end, items
            end += 1


class Searcher:
    """The matchers of one block of items, by window length."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            numbers = tuple(self.ids.setdefault(w, len(self.ids)) for w in words(text))
            length = min(window, len(numbers))
            if length:
                windows = by_length.setdefault(length, {})
                for i in range(len(numbers) - length + 1):
                    windows.setdefault(numbers[i : i + length], set()).add(item)
        self.matchers = [Matcher(k, v) for k, v in sorted(by_length.items())]

    def search(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        found, items = [], set()
        tokens = words(text)
        numbers = list(map(self.ids.get, tokens))
        for matcher in self.matchers:
            for end, names in matcher.search(numbers):
                found.append((end - matcher.length, end))
                items |= names
        return len(tokens), merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded size; the driver holds one partition and one block at a time."""
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t"))
    block, held = [], 0
    for row in rows.where("t is not null").toLocalIterator():
        size = len(row["t"].encode("utf-8"))
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["k"], row["t"]))
        held += size
    yield block


def _pass(docs: DataFrame, text: str, result: str, block, window: int, keep: list[str], first: bool) -> DataFrame:
    """One block of items against all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    fields = [docs.schema[c] for c in keep] + [T.StructField(result, RESULT)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(shared.value, window)
        for batch in batches:
            before = None if first else batch.column(result)
            rows = []
            for i, value in enumerate(batch.column(text)):
                n, hits, items = searcher.search(value.as_py())
                if before is not None:
                    old = before[i].as_py()
                    hits = merged(hits + [(h["first"], h["end"]) for h in old["hits"]])
                    items = items | set(old["items"])
                rows.append({"n_words": n, "hits": [{"first": a, "end": b} for a, b in hits], "items": sorted(items)})
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, _ARROW)], names=[*keep, result])

    return docs.mapInArrow(search, T.StructType(fields))


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    result: str = "contamination",
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add a struct column: words of the text, the word spans hit, and the items that occur.

    `keep` names the columns to return beside it (all, if not given).
    """
    result = free_name(docs, result)
    keep = docs.columns if keep is None else keep
    blocks = item_blocks(items, item_key, item_text, block_bytes)
    carried = list(dict.fromkeys([*keep, text]))
    docs, block, first = docs.select(*carried), next(blocks), True
    while block is not None:
        following = next(blocks, None)
        docs = _pass(docs, text, result, block, window, carried if following else keep, first)
        block, first = following, False
    return docs


def hit_words(result: str = "contamination"):
    """How many words of a document are hit."""
    lengths = F.transform(F.col(result)["hits"], lambda s: s["end"] - s["first"])
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def digest_columns(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, words, words hit, items that occur and their digest."""
    found = find_contamination(docs.select("doc_id", "text"), items, keep=["doc_id"])
    names = F.col("contamination.items")
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        hit_words().alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("contamination.hits") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no test string occurs, columns as they were."""
    result = free_name(docs, "contamination")
    found = find_contamination(docs, items, result=result, **options)
    return found.where(F.size(F.col(result)["hits"]) == 0).drop(result)

"""Phrases whose words stand together more often than apart, from a weighted de Bruijn graph.

A text is cut at signs into pieces, a piece into words. Nodes are runs of three words, edges are
runs of four, joining the nodes that overlap in two words.

1. *Edges.* Each word of a piece begins one longest gram: an edge if three words follow it in the
   piece, otherwise what is left of the piece, the end correction. All are counted per language.
2. *Node flow.* A node occurs as often as its edges leave it, plus as often as it ends a piece;
   the same holds for runs of two words and for words. So shorter counts are sums over longer
   ones, not further passes over the texts. Counts below `least` are only needed for these sums.
3. *Paths.* A node that one edge enters and one leaves, equally often, is unary. Edges that unary
   nodes join become one path, found by pointer doubling; every edge is in one path, and a path
   stands for all its runs of words. Long paths are kept in parts of `PART` edges. Edges on a ring
   of unary nodes have no first edge and stay paths of their own. Only edges counted at least
   `least` times are compacted: lesser ones have passed on their flow and can hold no phrase.
4. *Phrases.* Runs of two to four words, from the node flow and the paths, are scored at each cut,
   and those that live mostly inside a longer one go.

The grams are counted in `PASSES` passes, each over the grams whose first words fall into one class
of hashes (which the flow of a node shares), so that the shuffles of one pass take a share of the
disk; the texts are read once per pass. Grams are counted ahead of their shuffle, so frequent words,
pairs and passages make no partition heavy.

Scores are compared in whole numbers of 38 digits. Defined cases: a null text is empty; a null
language is `und`; texts without words add nothing; repeated rows count each time; ties of scores
are broken by count, then by the bytes of the phrase; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from macrospark.llm.common import pieces, text_of, written
from macrospark.llm.words import span_hashes, utf8

LONGEST = 4
LEAST = 30
SHARE = (80, 100)
TOP = 2000
SCALE = 2_000_000
PASSES = 3
PART = 1024

_SLICE = 4_000_000
_BLOCK = 500_000
_STEP = 50_000


def _exact(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def _first(phrase: Column, n: int) -> Column:
    return F.substring_index(phrase, " ", n)


def _kinds() -> np.ndarray:
    """0: part of a word, 1: blank, 2: sign that ends a piece."""
    kind = np.zeros(256, np.uint8)
    kind[[0x20, 0x09]] = 1
    kind[list(b".,;:!?\n\x0b\x0c\r")] = 2
    return kind


_KIND = _kinds()
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def grams_of(texts: pa.Array, number: int = 0, passes: int = 1, block: int = _BLOCK) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The longest grams of the texts whose first words fall into class `number`, and the texts they are from."""
    raw, at = utf8(texts)
    raw = _FOLD[raw]
    kind = _KIND[raw]
    word = kind == 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True  # words end with their texts
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    first, after = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    n = len(first)
    if not n:
        return
    doc = np.searchsorted(at, first, "right") - 1
    signs = np.cumsum(kind == 2, dtype=np.int32)[first]
    fresh = np.append(True, (signs[1:] != signs[:-1]) | (doc[1:] != doc[:-1]))
    heads = np.flatnonzero(fresh)
    piece_last = np.append(heads[1:], n)[np.cumsum(fresh) - 1] - 1
    # The words once more, with one space after each: every gram is a part of that.
    size = after - first
    start = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + n, 0x20, np.uint8)
    filled = np.ones(len(joined), bool)
    filled[start + size] = False
    joined[filled] = raw[word]
    last = np.minimum(np.arange(n) + LONGEST - 1, piece_last)
    stop = start[last] + size[last]
    chosen = np.arange(n)
    if passes > 1:
        chosen = np.concatenate([low + _of_class(joined, start[low : low + _STEP], size[low : low + _STEP], number, passes) for low in range(0, n, _STEP)])
    for low in range(0, len(chosen), block):
        some = chosen[low : low + block]
        lengths = stop[some] - start[some]
        offsets = np.append(0, np.cumsum(lengths))
        data = np.empty(offsets[-1], np.uint8)
        for i in range(0, len(some), _STEP):
            part, at_part = lengths[i : i + _STEP], offsets[i : i + _STEP + 1]
            data[at_part[0] : at_part[-1]] = joined[np.repeat(start[some[i : i + _STEP]] - at_part[:-1], part) + np.arange(at_part[0], at_part[-1])]
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        yield pa.Array.from_buffers(pa.string(), len(some), buffers), doc[some]


def _of_class(joined: np.ndarray, start: np.ndarray, size: np.ndarray, number: int, passes: int) -> np.ndarray:
    """Which of these consecutive words fall into class `number`; only their own bytes are hashed, which takes nine bytes for each."""
    low = start[0]
    hashes = span_hashes(joined[low : start[-1] + size[-1]], start - low, start + size - low)
    return np.flatnonzero(hashes % np.uint64(passes) == number)


def longest_grams(docs: DataFrame, text: str, lang: str, number: int = 0, passes: int = 1) -> DataFrame:
    """(lang, gram, n): for each word of a piece, it and the words after it, `LONGEST` at most, counted per slice of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1, _SLICE):
                langs = piece.column(0).dictionary_encode()
                of = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                for grams, doc in grams_of(piece.column(1), number, passes):
                    codes = grams.dictionary_encode()
                    code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                    found, n = np.unique(code * len(langs.dictionary) + of[doc], return_counts=True)
                    gram = codes.dictionary.take(pa.array(found // len(langs.dictionary)))
                    name = langs.dictionary.take(pa.array(found % len(langs.dictionary)))
                    yield pa.RecordBatch.from_arrays([name, gram, pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    return rows.mapInArrow(count, "lang string, gram string, n long")


def _words(column: str = "gram") -> Column:
    return F.size(F.split(F.col(column), " "))


def node_flow(grams: DataFrame, least: int) -> DataFrame:
    """(lang, size, gram, f): runs of one to `LONGEST` words that occur `least` times, from counted longest grams.

    Size 0 has the number of all words of the language. One chain of aggregates: a count that is
    large enough rides on as it is, and every count flows into the run that is a word shorter.
    """
    flow = grams.groupBy("lang", "gram").agg(F.sum("n").alias("f")).withColumn("size", F.lit(0))
    entry = lambda size, gram: F.struct(size.alias("size"), gram.alias("gram"), F.col("f"))
    for size in range(LONGEST - 1, -1, -1):
        shorter = _first(F.col("gram"), size) if size else F.lit("")
        onward = entry(F.lit(0), shorter)
        enough = (F.col("f") >= least) & (shorter != F.col("gram"))  # it has one word more
        out = (
            F.when(F.col("size") > 0, F.array(entry(F.col("size"), F.col("gram"))))
            .when(enough, F.array(entry(F.lit(size + 1), F.col("gram")), onward))
            .otherwise(F.array(onward))
        )
        flow = flow.select("lang", F.explode(out).alias("e")).select("lang", "e.*")
        flow = flow.groupBy("lang", "size", "gram").agg(F.sum("f").alias("f"))
    return flow.select("lang", "size", "gram", "f")


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, passes: int = PASSES) -> DataFrame:
    """`node_flow` of all texts; the numbers of words are summed over the passes."""
    parts = [written(node_flow(longest_grams(docs, text, lang, i, passes), least), "phrase-flow") for i in range(passes)]
    counted = reduce(DataFrame.unionByName, parts)
    words = counted.where("size = 0").groupBy("lang").agg(F.sum("f").alias("f"))
    words = words.select("lang", F.lit(0).alias("size"), F.lit("").alias("gram"), "f")
    return counted.where("size > 0").unionByName(words)


def unary_links(edges: DataFrame) -> DataFrame:
    """(lang, gram, before): the edge before each edge that begins in a unary node; edges (lang, gram, f)."""
    ends = lambda node, side: edges.select("lang", node.alias("node"), F.lit(side).alias("side"), "gram", "f")
    last = F.substring_index("gram", " ", 1 - LONGEST)
    both = ends(last, "in").unionByName(ends(_first(F.col("gram"), LONGEST - 1), "out"))
    of = lambda side, column: F.when(F.col("side") == side, F.col(column))
    nodes = both.groupBy("lang", "node").agg(
        F.count(of("in", "f")).alias("n_in"), F.count(of("out", "f")).alias("n_out"),
        F.max(of("in", "f")).alias("f_in"), F.max(of("out", "f")).alias("f_out"),
        F.max(of("in", "gram")).alias("before"), F.max(of("out", "gram")).alias("gram"),
    )
    unary = nodes.where("n_in = 1 and n_out = 1 and f_in = f_out and before <> gram")
    return unary.select("lang", "gram", "before")


def paths(edges: DataFrame, part: int = PART) -> DataFrame:
    """(lang, words, f): the edges (lang, gram, f), joined along unary nodes.

    Each edge is a run of `LONGEST` words of exactly one path, and has its weight.
    """
    linked = edges.select("lang", "gram", "f").join(unary_links(edges), ["lang", "gram"], "left")
    state = written(
        linked.select("lang", "gram", "f", F.coalesce("before", "gram").alias("head"), F.col("before").isNotNull().cast("long").alias("at")),
        "phrase-paths",
    )
    done = -1
    while True:
        # Each edge jumps to where the edge it points at points: twice as far as before.
        ahead = state.select("lang", F.col("gram").alias("head"), F.col("head").alias("next"), F.col("at").alias("more"))
        jumped = state.join(ahead, ["lang", "head"]).withColumn("ended", F.col("next") == F.col("head"))
        jumped = written(
            jumped.select("lang", "gram", "f", F.col("next").alias("head"), (F.col("at") + F.col("more")).alias("at"), "ended"),
            "phrase-paths",
        )
        ended = jumped.where("ended").count()
        state = jumped.drop("ended")
        if ended == done or ended == jumped.count():
            break
        done = ended  # as long as a path is left, each jump brings some edges to its head; rings never end
    alone = ~F.col("ended")
    placed = jumped.select(
        "lang", "gram", "f", F.when(alone, F.col("gram")).otherwise(F.col("head")).alias("head"), F.when(alone, 0).otherwise(F.col("at")).alias("at")
    )
    parts = placed.groupBy("lang", "head", F.floor(F.col("at") / part).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "gram"))).alias("edges"), F.first("f").alias("f")  # `part` at most
    )
    grams = F.transform("edges", lambda e: e["gram"])
    after = F.transform(F.slice(grams, 2, F.size(grams)), lambda g: F.substring_index(g, " ", -1))
    return parts.select("lang", F.concat(F.split(grams[0], " "), after).alias("words"), "f")


def _runs(words: Column, size: int) -> Column:
    """All runs of `size` words, joined by spaces; there are at least so many words."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.array_join(F.slice(words, i, size), " "))


def _inside(longer: DataFrame) -> DataFrame:
    """(lang, phrase, most): shorter runs inside longer phrases, with the largest of these phrases' counts.

    `longer`: (lang, words, f, size), where all runs of `size` words are such phrases.
    """
    shorter = [
        longer.where(F.col("size") > n).select("lang", F.explode(F.array_distinct(_runs(F.col("words"), n))).alias("phrase"), "f")
        for n in range(2, LONGEST)
    ]
    return reduce(DataFrame.unionByName, shorter).groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(counted: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases that stay, from `phrase_counts`."""
    edges = counted.where(F.col("size") == LONGEST)
    chains = written(paths(edges), "phrase-chains").withColumn("size", F.lit(LONGEST))
    short = counted.where(F.col("size").between(2, LONGEST - 1)).select("lang", F.col("gram").alias("phrase"), F.col("f").alias("a"))
    whole = chains.select("lang", F.explode(_runs(F.col("words"), LONGEST)).alias("phrase"), F.col("f").alias("a"))
    threes = counted.where(F.col("size") == LONGEST - 1).select("lang", F.split("gram", " ").alias("words"), "f", "size")
    inner = _inside(chains.unionByName(threes))
    part, whole_of = F.lit(share[0]), F.lit(share[1])
    kept = (
        short.unionByName(whole)
        .join(inner, ["lang", "phrase"], "left")
        .where(F.col("most").isNull() | (_exact(F.col("most")) * whole_of < _exact(F.col("a")) * part))
    )
    n = _words("phrase")
    kept = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    cut = kept.select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - size(split(phrase, ' ')))").alias("right"),
    )
    of = lambda side, name: counted.where("size > 0").select("lang", F.col("gram").alias(side), F.col("f").alias(name))
    cut = cut.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    score = F.expr(f"(cast(a as decimal(19,0)) * {SCALE}) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    words = counted.where("size = 0").select("lang", F.col("f").alias("n"))  # a row per language
    return lowest.join(words, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, passes: int = PASSES) -> DataFrame:
    """The first `top` phrases of each language, by score, count, and the phrase's bytes."""
    scored = collocations(phrase_counts(docs, text, lang, least, passes))
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


#: The same rows by counting every run of words for itself.
ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
worded as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces),
placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from worded),
grams as (select lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as phrase
  from placed, (select unnest([1, 2, 3, 4]) as m) where i + m - 1 <= len(w)),
f as (select lang, m, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f) as n from f where m = 1 group by lang),
candidates as (select lang, m, phrase, string_split(phrase, ' ') as w, f as a from f where m > 1 and f >= 30),
inner_runs as (
  select lang, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase, a
  from (select *, unnest(range(1, m - k + 2)) as i from candidates, (select unnest([2, 3]) as k) where k < m)),
most as (select lang, phrase, max(a) as longer from inner_runs group by all),
kept as (
  select c.* from candidates c left join most using (lang, phrase)
  where longer is null or 100 * cast(longer as hugeint) < 80 * cast(a as hugeint)),
cuts as (select *, unnest(range(1, m)) as k from kept),
scored as (
  select c.lang, c.phrase, c.a, c.k, l.f as l, r.f as r, cast(c.a as hugeint) * 2000000 // (l.f + r.f) as score
  from cuts c
  join f l on l.lang = c.lang and l.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, cast(rank as bigint) as rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""

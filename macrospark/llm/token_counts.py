"""Token counts of whole texts, without tokenising whole texts.

A merge of the tokenizer joins two neighbouring symbols into a piece of its vocabulary. Where no
piece has the two kinds of characters side by side that meet between two characters of a text
(white space, digits, signs, control characters, everything else), no merge can cross, and the
text is cut there without changing its tokens. The kinds that may meet are read from the model.

1. *Vocabulary.* The pre-tokens of all texts are counted; the pieces of each distinct one are
   counted once, by the tokenizer's own library.
2. *Frequent pre-tokens.* Those that make more than one in `HEAD` of all occurrences and have at
   most `LONGEST` bytes, hence fewer than `HEAD`, travel to the tasks, which add up their share of
   each text's tokens while they count that text's other pre-tokens.
3. *The rest.* The counts of other pre-tokens per text are joined to the vocabulary and summed. No
   key of that join holds more than one in `HEAD` of the occurrences, except pre-tokens of more
   than `LONGEST` bytes, which adaptive execution splits.

Ids are held only while one batch of distinct pre-tokens is counted. Each step is written to the
shared folder, so a lost executor costs one step.

Defined cases: a null text counts as empty, and has neither bytes nor tokens; texts of white space
only have the tokens that the library gives them; a text without any cut is one pre-token, however
long; repeated rows are each counted; an empty table gives an empty result; further columns are
passed on if named in `keep`, and result columns whose names are taken get `_` appended. Models
that rewrite texts (a normaliser other than the identity, removal of white space, white space as
suffix) are refused, since their texts cannot be cut beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrospark.llm.common import free_name, pieces, text_of, written
from macrospark.llm.words import utf8

MODEL = "piece_bpe_32k.model"
HEAD = 1 << 20
LONGEST = 32
LIMIT = 4096

_SPACE_MARK = "▁"
_SLICE = 4_000_000
_KINDS = 5


def _kinds() -> np.ndarray:
    """0: space, 1: control, 2: digits, 3: signs, 4: letters and every byte of other characters."""
    kind = np.full(256, 3, np.uint8)
    kind[:0x20] = kind[0x7F] = 1
    kind[0x20] = 0
    kind[0x30:0x3A] = 2
    kind[0x41:0x5B] = kind[0x61:0x7B] = kind[0x80:] = 4
    return kind


_KIND = _kinds()


def model_path(name: str = MODEL) -> str:
    """Where this machine's tokenizer files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokenizer:
    """A SentencePiece BPE model, and the kinds of characters between which it never merges."""

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(proto)
        how, trained = model.normalizer_spec, model.trainer_spec
        kind = sentencepiece_model_pb2.TrainerSpec.ModelType.Name(trained.model_type)
        if kind != "BPE" or how.precompiled_charsmap or how.remove_extra_whitespaces:
            raise ValueError("only BPE models over texts as they stand can be counted by pre-tokens")
        if not how.escape_whitespaces or not how.add_dummy_prefix or trained.treat_whitespace_as_suffix:
            raise ValueError("only models that mark white space in front of words can be counted by pre-tokens")
        how.add_dummy_prefix = False  # a text's first pre-token has it already
        self.proto = model.SerializeToString()
        self.cuts = np.ones((_KINDS, _KINDS), bool)
        self.cuts[4, 4] = False  # never inside a character
        symbol = sentencepiece_model_pb2.ModelProto.SentencePiece
        for piece in model.pieces:
            if piece.type in (symbol.NORMAL, symbol.USER_DEFINED, symbol.UNUSED):
                met = _KIND[np.frombuffer(piece.piece.replace(_SPACE_MARK, " ").encode(), np.uint8)]
                self.cuts[met[:-1], met[1:]] = False

    def pretokens(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pre-tokens of all texts in order, and where each text's begin (one more entry than texts)."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), _SPACE_MARK, " ")
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        raw, at = utf8(texts)
        kind = _KIND[raw]
        begins = np.empty(len(raw), bool)
        begins[1:] = self.cuts.ravel()[kind[:-1] * np.uint8(_KINDS) + kind[1:]]
        begins[at[:-1][at[:-1] < len(raw)]] = True
        first = np.flatnonzero(begins)
        offsets = np.append(first, len(raw)).astype(np.int32)
        found = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        return found, np.searchsorted(first, at)

    def counter(self):
        """Counts the pieces of a list of pre-tokens."""
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_proto=self.proto)
        return lambda tokens: [len(ids) for ids in library.encode(tokens, num_threads=1)]


def vocabulary(docs: DataFrame, text: str, tokenizer: Tokenizer) -> DataFrame:
    """(pretoken, n, pieces): each distinct pre-token, its occurrences, and the pieces it makes."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)  # the model file, under a megabyte

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, _SLICE):
                codes = shared.value.pretokens(piece.column(0))[0].dictionary_encode()
                n = np.bincount(codes.indices.to_numpy(zero_copy_only=False), minlength=len(codes.dictionary))
                yield pa.RecordBatch.from_arrays([codes.dictionary, pa.array(n.astype(np.int64))], names=["pretoken", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value.counter()
        for batch in batches:
            n = pa.array(count(batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["pretoken", "n", "pieces"])

    distinct = docs.select(text_of(text).alias("t")).mapInArrow(found, "pretoken string, n long")
    distinct = distinct.groupBy("pretoken").agg(F.sum("n").alias("n"))
    return written(distinct.mapInArrow(counted, "pretoken string, n long, pieces long"), "token-vocabulary")


def frequent(vocab: DataFrame, head: int = HEAD, longest: int = LONGEST) -> tuple[pa.Array, np.ndarray]:
    """Fewer than `head` pre-tokens of at most `longest` bytes, and their pieces."""
    total = vocab.agg(F.sum("n")).first()[0] or 0
    some = vocab.where((F.col("n") > total // head) & (F.octet_length("pretoken") <= longest)).select("pretoken", "pieces").toArrow()
    return some.column(0).combine_chunks().cast(pa.string()), some.column(1).to_numpy()


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    model: str | None = None,
    keep: list[str] | None = None,
    head: int = HEAD,
    longest: int = LONGEST,
) -> DataFrame:
    """The columns `keep` (all, if not given) with the bytes and tokens of each text: n_bytes, n_tokens.

    `model` is the path of the SentencePiece model on the driver; the tasks get its bytes.
    """
    keep = docs.columns if keep is None else keep
    with open(model or model_path(), "rb") as file:
        tokenizer = Tokenizer(file.read())
    vocab = vocabulary(docs, text, tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, *frequent(vocab, head, longest)))
    t, n_bytes, n_tokens = free_name(docs, "_t"), free_name(docs, "n_bytes"), free_name(docs, "n_tokens")
    row, rest = free_name(docs, "_row"), free_name(docs, "_rest")
    entry = T.StructType([T.StructField("pretoken", T.StringType()), T.StructField("n", T.LongType())])
    fields = [docs.schema[c] for c in keep]
    fields += [T.StructField(n_bytes, T.LongType()), T.StructField(n_tokens, T.LongType()), T.StructField(rest, T.ArrayType(entry))]

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known, known_pieces = shared.value
        known_pieces = np.append(known_pieces, 0).astype(float)
        for batch in batches:
            for piece in pieces(batch, len(keep), _SLICE):
                texts = piece.column(len(keep))
                found, at = tokenizer.pretokens(texts)
                n, codes = len(texts), found.dictionary_encode()
                place = pc.fill_null(pc.index_in(codes.dictionary, known), len(known)).to_numpy(zero_copy_only=False)
                code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                of = np.repeat(np.arange(n), np.diff(at))
                sums = np.bincount(of, known_pieces[place[code]], n).astype(np.int64)
                other = place[code] == len(known)
                size = max(len(codes.dictionary), 1)
                pair, times = np.unique(of[other] * size + code[other], return_counts=True)
                ends = np.searchsorted(pair, np.arange(n + 1) * size)
                entries = pa.StructArray.from_arrays(
                    [codes.dictionary.take(pa.array(pair % size)), pa.array(times.astype(np.int64))], names=["pretoken", "n"]
                )
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
                length = pc.cast(pc.binary_length(texts), pa.int64())
                columns = [*(piece.column(i) for i in range(len(keep))), length, pa.array(sums), lists]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, n_bytes, n_tokens, rest])

    texts = docs.select(*[F.col(f"`{c}`") for c in keep], text_of(text).alias(t))
    counted = texts.mapInArrow(counts, T.StructType(fields)).withColumn(row, F.monotonically_increasing_id())
    counted = written(counted, "token-counts", "zstd")  # from here on the row numbers stand
    others = counted.select(row, F.explode(rest).alias("e")).select(row, "e.pretoken", "e.n")
    added = others.join(vocab.select("pretoken", "pieces"), "pretoken").groupBy(row).agg(F.sum(F.col("n") * F.col("pieces")).alias(rest))
    return counted.drop(rest).join(added, row, "left").select(
        *[F.col(f"`{c}`") for c in keep], n_bytes, (F.col(n_tokens) + F.coalesce(F.col(rest), F.lit(0))).alias(n_tokens)
    )


def digest_columns(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, bytes, tokens, and whether the tokens are more than `limit`."""
    counted = count_tokens(docs.select("doc_id", "text"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

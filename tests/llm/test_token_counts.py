"""Token counts against the tokenizer's own library on whole texts."""

import pyarrow as pa
import pytest
import sentencepiece

from macrospark.llm import token_counts
from macrospark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

TEXTS = [
    "", " ", "   ", "\n", "a", " a", "a ", "  two  spaces  ", "tabs\tand\nlines\r\n", "1234567890 12.5%", "<s>hello</s> <unk> <0x0A>",
    "▁already▁marked ▁ x", "Ünïcödé wörds àre kept", "日本語のテキスト、句読点。", "emoji 😀😀 family 👨‍👩‍👧", "\x00\x01\x7f",
    "x" * 5000, "don't stop-me_now (really!) [ok] {a:b}", "http://example.org/a/b?c=d#e", "é combining", "a" * 40 + " " * 40 + "b" * 40,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())


@pytest.fixture(scope="module")
def tokenizer():
    with open(token_counts.model_path(), "rb") as file:
        return token_counts.Tokenizer(file.read())


def test_cut_texts_have_the_tokens_of_whole_ones(library, tokenizer):
    count = tokenizer.counter()
    found, at = tokenizer.pretokens(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        assert sum(count(found[at[i] : at[i + 1]].to_pylist())) == len(library.encode(text)), repr(text)


def test_query_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op11_token_counts"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    for r in found:
        n = len(library.encode(docs[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 4096)


@pytest.mark.parametrize("head,longest", [(1 << 18, 32), (3, 32), (1 << 18, 1)])
def test_frequent_and_other_pretokens_add_up(spark, library, head, longest):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)
    found = token_counts.count_tokens(docs, head=head, longest=longest).collect()
    assert {r["id"]: r["n_tokens"] for r in found} == {i: len(library.encode(t)) for i, t in enumerate(TEXTS)}


def test_odd_rows(odd, none, library):
    found = token_counts.count_tokens(odd.withColumnRenamed("key", "n_tokens"))
    assert found.columns == ["doc_id", "text", "node", "n_tokens", "n_bytes", "n_tokens_"]
    rows = found.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["n_bytes"], r["n_tokens_"]) == (len((r["text"] or "").encode()), len(library.encode(r["text"] or "")))
    assert token_counts.count_tokens(none).count() == 0


def test_refuses_models_that_rewrite_texts():
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(token_counts.model_path(), "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        token_counts.Tokenizer(model.SerializeToString())

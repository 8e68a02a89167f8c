"""Token counts and BPE against the libraries themselves."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fareloom.llm import bpe, queries, token_counts


LIBRARY = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


@pytest.fixture(scope="module")
def library():
    return LIBRARY


@pytest.fixture(scope="module")
def pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.SentencePieceProcessor(model_file=path)


def test_token_counts_query_is_the_library(spark, small_dir, rows_of, pieces):
    got = {r["doc_id"]: r for r in queries.all_queries()["op10_token_counts"](spark, small_dir).collect()}
    for doc_id, text in rows_of(f"{small_dir}/documents.parquet", "doc_id, text"):
        n = len(pieces.encode(text))
        row = got[doc_id]
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), n)
        assert row["over_limit"] == (n > 4096)


def test_token_counts_of_odd_rows(odd, nothing, pieces):
    rows = token_counts.token_counts(odd, limit=2).collect()
    texts = [r["text"] or "" for r in odd.collect()]
    assert [r["n_tokens"] for r in rows] == [len(pieces.encode(t)) for t in texts]
    assert token_counts.token_counts(nothing).collect() == []


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"])
def test_parts_of_long_texts_add_up(name):
    model = token_counts.counter(name)
    text = ("The end. Two  spaces, a\nbreak and 12 34 words é " * 400).encode()
    assert len(list(token_counts.parts(text, model.keeps_space, 200))) > 20
    assert token_counts.count_batch([text, b""], model, 200) == [model.counts([text.decode()])[0], 0]


def check(texts, library):
    got = bpe.encoder(bpe.TOKENIZER).encode(texts)
    for (ids, decoded), known in zip(
        got, library.encode_batch(texts, add_special_tokens=False), strict=True
    ):
        assert np.frombuffer(ids, "<u4").tolist() == known.ids
        assert decoded == library.decode(known.ids, skip_special_tokens=False)


def test_bpe_query_is_the_library(spark, small_dir, rows_of, library):
    got = {r["doc_id"]: r for r in queries.all_queries()["op7_bpe"](spark, small_dir).collect()}
    for doc_id, text in rows_of(f"{small_dir}/documents.parquet", "doc_id, text"):
        known = library.encode(text, add_special_tokens=False).ids
        row = got[doc_id]
        assert row["n_tokens"] == len(known)
        assert row["ids_sha256"] == sha256(np.array(known, "<u4").tobytes()).hexdigest()
        decoded = library.decode(known, skip_special_tokens=False)
        assert row["decoded_sha256"] == sha256(decoded.encode()).hexdigest()


def test_bpe_of_odd_rows(odd, nothing, library):
    texts = [r["text"] or "" for r in odd.collect()]
    check(texts, library)
    rows = bpe.encode_documents(odd).collect()
    known = library.encode_batch(texts, add_special_tokens=False)
    assert [r["ids"] for r in rows] == [k.ids for k in known]
    assert bpe.token_digests(nothing).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_bpe_of_any_text(text):
    check([text], LIBRARY)


def test_bpe_of_every_latin_character():
    characters = [chr(c) for c in range(0x250)]
    check([f"{c} a{c} {c}B {c}{c}, Été{c}." for c in characters], LIBRARY)


def test_both_trees_agree(library):
    random.seed(1)
    vocabulary = bpe.encoder(bpe.TOKENIZER).vocabulary
    for _ in range(200):
        word = "".join(random.choice("theranigo") for _ in range(random.randint(2, 40)))
        data = np.frombuffer(word.encode(), np.uint8)
        symbols = vocabulary.inner[data]
        symbols[-1] = vocabulary.final[data[-1]]
        long = bpe.encode_long(symbols.tolist(), vocabulary)
        padded = np.full((1, 64), -1, np.int64)
        padded[0, : len(symbols)] = symbols
        side = bpe.encode_side_by_side(padded, vocabulary)
        assert side[side >= 0].tolist() == long


def test_words_are_forgotten_and_learnt_again(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    coder = bpe.Encoder(bpe.Vocabulary(public_tokenizers.path(bpe.TOKENIZER)))
    texts = [f"alpha beta w{i} gamma w{i % 3}" for i in range(30)]
    for text in texts:
        known = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode([text])[0][0], "<u4").tolist() == known


def test_pieces_are_encoded_once_in_whatever_words(monkeypatch, library):
    coder, encoded, whole = bpe.encoder(bpe.TOKENIZER), [], bpe.encode_side_by_side

    def counted(symbols, vocabulary):
        encoded.append(len(symbols))
        return whole(symbols, vocabulary)

    monkeypatch.setattr(bpe, "encode_side_by_side", counted)
    for text, pieces in [("alpha beta ( ) ,", 5), ("Alpha, (BETA) beta,alpha", 0), ("(gamma)", 1)]:
        encoded.clear()
        known = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode([text])[0][0], "<u4").tolist() == known
        assert sum(encoded) == pieces


def test_special_tokens_between_pieces(library):
    token = "<|endoftext|>"
    check([f"a{token}b", f"{token}{token}", f"'s{token}'S It's　d'Été \x1c.{token} ½12", ""], library)


def test_encoded_texts_are_let_go():
    coder = bpe.encoder(bpe.TOKENIZER)
    texts = [b"alpha beta gamma " * 1000] * 20
    coder.tokens(texts).array()
    before = pa.total_allocated_bytes()
    for _ in range(5):
        assert len(coder.tokens(texts).array()) == 20
    assert pa.total_allocated_bytes() - before < 100_000

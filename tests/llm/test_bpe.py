from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, make_docs
from tomeworks.llm import bpe


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)))


@pytest.fixture(scope="module")
def tiktoken_encoding(encoder):
    ranks = {entry: rank for rank, entry in enumerate(encoder.entries)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(encoder):
    assert sorted(encoder.hash.slots) == list(range(len(encoder.entries)))
    assert all(encoder.hash.find(entry) == rank for rank, entry in enumerate(encoder.entries))
    assert encoder.hash.find(b"surely no entry of it") == -1


@pytest.mark.parametrize("keys", [[], [b"a"], [b"a", b"b", b"c"]])
def test_perfect_hash_of_few_keys(keys):
    made = bpe.PerfectHash(keys)
    assert [made.find(k) for k in keys] == list(range(len(keys)))
    assert not keys or made.find(b"z") == -1


@pytest.mark.parametrize(
    "text", ["", " ", "  a\n\n b  ", "日本語 テキスト 🙂🙂 <|endoftext|>", "a" * 3000, "éx'll 123456", "\x00\x1f　x"]
)
def test_like_the_library(encoder, tiktoken_encoding, text):
    ids = encoder.encode(text)
    assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)
    assert encoder.decode(ids) == text.encode()


def test_round_trip_of_odd_rows(spark):
    docs = make_docs(spark, ODD).withColumn("ids", F.lit("clash"))
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        assert bytes(row.decoded) == (row.text or "").encode()
        assert row.n_tokens == len(row.ids)
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_query(spark, folder, tiktoken_encoding):
    rows = bpe.op5_byte_bpe(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = tiktoken_encoding.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_the_plain_pattern_splits_alike(encoder):
    every = [chr(c) for c in range(0x180) if bpe._PLAIN.fullmatch(chr(c))]
    assert len(every) > 250
    for a in every:
        text = f"{a}x {a}{a} 1{a}2 {a}\n {a} 's{a}"
        assert encoder.split_plain(text) == encoder.split_any(text), repr(a)


def test_memory_keeps_what_is_asked_for(monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 3)
    asked = []
    memory = bpe.Memory(lambda t: asked.append(t) or (len(t),))
    for token in "a b c a d a e f a g".split():
        memory[token]
    assert asked == ["a", "b", "c", "d", "e", "f", "g"]


def test_pre_tokens_of_many_texts_are_merged_side_by_side(encoder, monkeypatch):
    draw = random.Random(5)
    texts = ["", "a" * 500, "日本語 テキスト 🙂🙂", *("".join(draw.choices("abethingsé 12'\n", k=60)) for _ in range(200))]
    one_by_one = [encoder.encode(text).tolist() for text in texts]
    encoder.known.forget()
    merged = []
    alone = encoder.merged
    monkeypatch.setattr(encoder, "merged", lambda piece: merged.append(piece) or alone(piece))
    monkeypatch.setattr(bpe, "_TOGETHER", 3000)
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode_all(texts)] == one_by_one
    assert merged == [b"a" * 500]


def test_all_keys_at_once(encoder):
    keys = [*encoder.entries[:2000], b"surely no entry of it", b""]
    assert encoder.hash.find_all(keys) == [encoder.hash.find(key) for key in keys]
    assert bpe.PerfectHash([]).find_all([b"z"]) == [-1]


def test_texts_of_a_batch_are_encoded_once(encoder, monkeypatch):
    calls = []
    encode = encoder.encode_all
    monkeypatch.setattr(encoder, "encode_all", lambda texts: calls.append(len(texts)) or encode(texts))
    one, other = pa.array(["a b", "", "abethings"]), pa.array(["a b", "", "abethingz"])
    for column in (one, pa.array(one.to_pylist()), other, one):
        assert encoder.encode_batch(column).to_pylist() == [encoder.encode(x).tolist() for x in column.to_pylist()]
    assert calls == [3, 3, 3]

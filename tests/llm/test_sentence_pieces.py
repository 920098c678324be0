from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, folder_of, make_docs
from tomeworks.llm import sentence_pieces as sp

TEXTS = [
    "", " ", "  a  b ", "a\n\tb", "▁a▁▁ b", "日本語 テキスト 🙂🙂</s> <s><unk>", "\x00 <0x0A> ﬁ ＡＢ　éé",
    "x" * 70 + " " * 40 + "antidisestablishmentarianism" * 5, "été naïve Straße 12345 3.14", "￿ 😀\U0010ffff�", " leading", "trailing  ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sp.MODEL))


@pytest.fixture(scope="module")
def model():
    return sp.Segmenter(public_tokenizers.path(sp.MODEL))


def ids_of(model, text):
    words = sp.words_of(text)
    assert "".join(sp.MARK + w for w in words) == sp.marked(text)
    found = model.segment(sorted(set(words)))
    return [i for w in words for i in memoryview(found[w]).cast("i").tolist()]


@pytest.mark.parametrize("text", TEXTS)
def test_like_the_library(model, library, text):
    ids = ids_of(model, text)
    assert ids == library.encode(text)
    assert model.decode(ids).decode() == library.decode(ids)


def test_random_texts(model, library):
    draw = random.Random(5)
    alphabet = "aabbcdeeehilnnoorsttu  \n\t▁éß日語🙂01,.-"
    for n in range(600):
        text = "".join(draw.choices(alphabet, k=draw.randrange(n % 200 + 1)))
        assert ids_of(model, text) == library.encode(text), text


def test_a_word_alone_is_merged_as_among_others(model):
    draw = random.Random(6)
    words = ["".join(draw.choices("abeinorst", k=draw.randrange(1, 60))) for _ in range(500)]
    assert model.segment(words) == {w: model._alone(sp.MARK + w) for w in words}


def test_any_ids_are_decoded_like_the_library(model, library):
    draw = random.Random(7)
    for _ in range(500):
        ids = [draw.choice([draw.randrange(3, 259), draw.randrange(3, 32000)]) for _ in range(draw.randrange(12))]
        assert model.decode(ids).decode() == library.decode(ids), ids
    assert model.decode([1, 2]) == b""


@pytest.mark.parametrize("table_bytes", [0, 2_000, sp.TABLE_BYTES])
def test_odd_rows_with_any_table(spark, library, table_bytes):
    rows = [*ODD, *[(100 + i, t, "en", "a", len(t)) for i, t in enumerate(TEXTS)]]
    docs = make_docs(spark, rows).withColumns({"ids": F.lit("clash"), "word": F.lit("w"), "n": F.lit(1)})
    got = sp.decode(sp.encode(docs, table_bytes=table_bytes)).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.ids == library.encode(row.text or "", add_eos=True)
        assert bytes(row.decoded).decode() == library.decode(row.ids)
        assert row.n_tokens == len(row.ids) and row.word == "w"
    assert sp.encode(docs.limit(0)).count() == 0


def test_the_table_holds_each_recurring_word_once(spark, tmp_path):
    docs = make_docs(spark, ["la la land", "la la", "rare"])
    table = sp.chunk_table(docs.coalesce(1), sp.segmenter(spark))
    assert [r.word for r in table.collect()] == ["la"]


def test_query(spark, folder, library, tmp_path):
    rows = sp.op13_sentence_pieces(spark, folder).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    odd = sp.op13_sentence_pieces(spark, folder_of(tmp_path, spark, make_docs(spark, ODD)))
    assert odd.count() == len(ODD)

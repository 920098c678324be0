from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, make_docs
from tomeworks.llm import line_dedup


def parted(one, other):
    """Whether a boundary lies between two neighbouring lines."""
    both = xxhash.xxh3_64_intdigest(one.encode()) * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(other.encode())
    return both % 2**64 >= 2**61


def plain_chunks(lines):
    """Sets of lines, by looking at every stretch of lines."""
    worded = [i for i, line in enumerate(lines) if line.strip(" \t\v\f\r")]
    cut = [True, *(parted(lines[a], lines[b]) for a, b in zip(worded, worded[1:])), True]
    for i in range(len(worded)):
        for j in range(i + 1, len(worded)):
            whole = cut[i] and cut[j + 1] and not any(cut[i + 1 : j + 1])
            if whole or (j == i + 1 and cut[j]):
                yield range(worded[i], worded[j] + 1)
            if not whole and any(cut[i + 1 : j + 1]):
                break


def brute(rows):
    """What is left of each (doc_id, text), by looking at all chunks in order of id and text digest."""
    key = lambda r: hashlib.md5(f"{'-' if r[0] is None else r[0]}:{r[1] or ''}".encode()).digest()
    order = sorted({(r[0] is not None, r[0] or 0, key(r), r[1]) for r in rows if r[1]}, key=lambda x: x[:3])
    seen, left = set(), {}
    for _, _, k, text in order:
        lines, gone = text.split("\n"), set()
        for place in plain_chunks(lines):
            chunk = "\n".join(lines[i] for i in place)
            if chunk in seen:
                gone |= set(place)
            seen.add(chunk)
        left[k] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return [left.get(key(r), r[1]) for r in rows]


def sentences(rng, n):
    return [f"line {rng.randrange(10**9)} says something" for _ in range(n)]


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = {r.doc_id: r for r in line_dedup.op1_line_dedup(spark, folder).collect()}
    assert len(rows) == len(docs)
    assert [rows[i].text for i, _ in docs] == brute(docs)
    assert all(rows[i].n_lines - rows[i].n_removed == len((rows[i].text).split("\n")) for i, _ in docs if rows[i].text)
    assert any(r.n_removed for r in rows.values())


def test_shifted_blocks_are_found(spark):
    rng = random.Random(3)
    block = sentences(rng, 60)
    texts = ["\n".join(sentences(rng, rng.randrange(1, 9)) + block + sentences(rng, 5)) for _ in range(20)]
    texts += ["\n".join(block[:30] + ["an inserted line"] + block[30:])] + ["\n".join(sentences(rng, 40)) for _ in range(5)]
    rows = sorted(line_dedup.remove_repeats(make_docs(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == brute(list(enumerate(texts)))
    assert rows[0].n_removed == 0
    assert all(r.n_removed >= 40 for r in rows[1:20])
    assert rows[20].n_removed >= 30
    assert all(r.n_removed == 0 for r in rows[21:])


def test_equal_digests_of_different_bytes_stay(spark, monkeypatch):
    """The digest only nominates; the bytes decide."""
    texts = ["a b\nc d", "e f\ng h", "a b\nc d"]
    chunks = line_dedup.repeated_chunks(make_docs(spark, texts))
    assert [(r.doc_id, r.first, r.stop) for r in chunks.collect()] == [(2, 0, 2)]

    def one_digest(batches):
        for batch in line_dedup_rows(batches):
            place = batch.schema.get_field_index("digest")
            yield batch.set_column(place, "digest", pa.array([b"same"] * batch.num_rows, pa.binary()))

    line_dedup_rows = line_dedup._chunk_rows
    monkeypatch.setattr(line_dedup, "_chunk_rows", one_digest)
    chunks = line_dedup.repeated_chunks(make_docs(spark, texts))
    assert [(r.doc_id, r.first, r.stop) for r in chunks.collect()] == [(2, 0, 2)]


def test_frequent_chunks_without_broadcast(spark, monkeypatch):
    """The same rows whether first occurrences are sent everywhere, only the frequent ones, or none."""
    rng = random.Random(8)
    popular, rare = sentences(rng, 3), [sentences(rng, 4) for _ in range(30)]
    texts = ["\n".join(sentences(rng, 3) + popular + rare[i % 30]) for i in range(90)]
    assert all(x != y for x, y in zip(texts, brute(list(enumerate(texts)))[30:]))
    for limit in (1 << 24, 2000, 0):
        monkeypatch.setattr(line_dedup, "_FIRSTS_BYTES", limit)
        rows = sorted(line_dedup.remove_repeats(make_docs(spark, texts)).collect(), key=lambda r: r.doc_id)
        assert [r.text for r in rows] == brute(list(enumerate(texts)))


def test_blank_blocks_stay(spark):
    rows = line_dedup.remove_repeats(make_docs(spark, ["\n\n\n", "\n\n\n", "x\n\n", "x\n\n"])).collect()
    assert all(r.n_removed == 0 for r in rows)


def test_odd_rows(spark, monkeypatch):
    extra = [(None, "p q\nr s", "en", "a", 7), (7, "p q\nr s", "en", "a", 7), (7, "p q\nr s", "en", "a", 7), (8, "p q\nr s\nt", "en", "a", 9)]
    docs = make_docs(spark, ODD + extra).withColumn("n_removed", F.lit("clash")).withColumn("key", F.lit("clash"))
    rows = line_dedup.remove_repeats(docs).collect()
    assert len(rows) == len(ODD) + 4
    assert sorted(str(r.text)[:50] for r in rows) == sorted(str(t)[:50] for t in brute(ODD + extra))
    kept = line_dedup.stage_docs(docs)
    assert kept.columns == docs.columns
    assert sum(r.doc_id == 7 for r in kept.collect()) == 0
    assert all(r.n_chars == len(r.text) for r in kept.collect() if r.text)
    assert line_dedup.remove_repeats(docs.limit(0)).count() == 0
    monkeypatch.setattr("tomeworks.llm.common.BROADCAST_ROWS", 0)
    assert sorted(str(r.text) for r in line_dedup.remove_repeats(docs).collect()) == sorted(str(r.text) for r in rows)


def test_short_passages_and_blank_lines_between(spark):
    """Of passages of 2 to 6 lines in other surroundings, with blank lines between or not, nine tenths of each length are found."""
    rng = random.Random(5)
    passages = [("\n\n" if i % 2 else "\n").join(sentences(rng, 2 + i // 2 % 5)) for i in range(1000)]
    around = lambda p: "\n".join([*sentences(rng, rng.randrange(1, 9)), p, *sentences(rng, 5)])
    texts = [around(p) for p in passages] + [around(p) for p in passages]
    rows = {r.doc_id: r for r in line_dedup.remove_repeats(make_docs(spark, texts)).collect()}
    assert all(rows[i].n_removed == 0 for i in range(1000))
    found, lines = {k: [] for k in range(2, 7)}, []
    for i, passage in enumerate(passages):
        own = [line for line in passage.split("\n") if line]
        gone = [line not in rows[1000 + i].text for line in own]
        found[len(own)].append(any(gone))
        lines += gone
        assert rows[1000 + i].text.split("\n")[-5:] == texts[1000 + i].split("\n")[-5:]
    assert all(sum(own) >= 0.9 * len(own) for own in found.values())
    assert sum(lines) >= 0.95 * len(lines)

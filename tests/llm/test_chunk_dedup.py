from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, make_docs
from tomeworks.llm import chunk_dedup as c


def plain_ends(data):
    gear = [int(x) for x in c._GEAR]
    ends, last, h = [], 0, 0
    for i, b in enumerate(data):
        h = (h * 2 + gear[b]) % 65536
        at = i + 1
        if at - last >= c.LEAST and h & 0xF800 == 0 or at - last == c.MOST:
            ends.append(at)
            last = at
    return ends + [len(data)] * (len(data) > last)


def brute(rows, min_run=c.MIN_RUN):
    """(doc_id, start, stop) of the repeated passages, rows in order."""
    seen, found = set(), []
    for doc_id, text in rows:
        data, start, run = (text or "").encode(), 0, None
        for end in plain_ends(data) + [None]:
            chunk = data[start:end] if end else None
            if chunk is not None and chunk in seen:
                run = (run[0] if run else start, end)
            else:
                if run and run[1] - run[0] >= min_run:
                    found.append((doc_id, *run))
                run = None
                seen.add(chunk)
            start = end
    return sorted(found)


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(n)]


def test_ends():
    rng = random.Random(1)
    for n in (0, 1, 15, 16, 17, 96, 97, 5000):
        data = bytes(rng.randrange(256) for _ in range(n))
        assert c.chunk_ends(data) == plain_ends(data)
    assert c.chunk_ends(b"a" * 1000) == plain_ends(b"a" * 1000)


def test_ends_of_a_text_in_parts(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 9000).astype(np.uint8).tobytes()
    expected = c.chunk_ends(data)
    for part in (100, 333, 4096):
        monkeypatch.setattr(c, "_PART", part)
        assert c.chunk_ends(data) == expected


def test_query(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = c.op10_chunk_dedup(spark, folder).collect()
    assert sorted((r.doc_id, r.start_byte, r.stop_byte) for r in rows) == brute(docs)
    assert rows


def test_passages_of_fifty_words(spark):
    rng = random.Random(9)
    passages = [words(rng, 55) for _ in range(40)]
    texts = []
    for i in range(120):
        texts.append(" ".join(words(rng, rng.randrange(20, 90)) + passages[i % 40] + words(rng, rng.randrange(20, 90))))
    texts += [" ".join(words(rng, 100)) for _ in range(50)]
    docs = make_docs(spark, texts).coalesce(1)
    rows = c.passages(docs).collect()
    assert {r.doc_id for r in rows} == set(range(40, 120))
    assert all(r.first_doc_id % 40 == r.doc_id % 40 and r.first_doc_id < r.doc_id for r in rows)
    cleaned = {r.doc_id: r.text for r in c.remove_repeats(docs).collect()}
    assert all(cleaned[i] == texts[i] for i in [*range(40), *range(120, 170)])
    assert all(len(cleaned[i]) <= len(texts[i]) - c.MIN_RUN for i in range(40, 120))


def test_odd_rows(spark):
    long = " ".join(words(random.Random(4), 200)) + " é🙂日本語 " * 30
    rows = ODD + [(9, long, "en", "a", 1), (9, long, "en", "a", 1), (None, long, "en", "a", 1)]
    docs = make_docs(spark, rows).withColumn("row", F.lit("clash")).withColumn("d1", F.lit("clash")).coalesce(1)
    cleaned = c.remove_repeats(docs)
    assert cleaned.columns == docs.columns
    assert cleaned.count() == len(rows)
    assert [r.text for r in cleaned.collect() if r.text == long and r.doc_id == 9] == [long]
    assert sum(r.text is None for r in cleaned.collect()) == 2
    assert c.passages(docs.limit(0)).count() == 0
    assert c.remove_repeats(docs.limit(0)).count() == 0

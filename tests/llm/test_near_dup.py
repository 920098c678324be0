from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, folder_of, make_docs
from tomeworks.llm import near_dup
from tomeworks.llm.components import components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(texts, size, percent=80):
    """{doc_id: smallest id reachable}"""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        met = {}
        for x in s:
            for j in holders[x]:
                met[j] = met.get(j, 0) + 1
        for j, n in met.items():
            if j < i and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def test_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected, sizes = brute(texts, 2)
    rows = near_dup.op8_near_dup(spark, folder).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.n_shingles for r in rows} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(texts)
    assert any(not r.kept for r in rows)


def mutated(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_around_a_base_and_chains(spark, tmp_path, monkeypatch):
    """Copies that are only linked by way of others; tiny blocks, so that groups are cut up."""
    rng = random.Random(5)
    base = [f"v{rng.randrange(400)}" for _ in range(90)]
    texts = [mutated(rng, base, rng.randrange(0, 9)) for _ in range(150)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(30):
        texts.append(" ".join(chain))
        chain[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
        chain[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) for _ in range(30)]
    texts += ["", None, "  ", "one", "One", "a b", "b a", "A B"]
    rng.shuffle(texts)
    monkeypatch.setattr(near_dup, "BLOCK", 700)
    rows = near_dup.op8_near_dup(spark, folder_of(tmp_path / "t", spark, make_docs(spark, texts))).collect()
    expected, sizes = brute(dict(enumerate(texts)), 2)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.n_shingles for r in rows} == sizes


def test_odd_rows(spark):
    docs = make_docs(spark, ODD).withColumn("key", F.lit("clash")).withColumn("words", F.lit("clash"))
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == len(ODD)
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id is not None) == [
        (1, 1), (1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6),
    ]
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    # of the repeated rows one stays; those that share an id but not the text are two documents
    kept = near_dup.stage_docs(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(ODD) - 2
    assert near_dup.stage_docs(docs.limit(0)).count() == 0


def test_one_stays_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs(spark, [text, "something else altogether of a few words", text + " more", text.upper(), text])
    assert sorted(r.doc_id for r in near_dup.stage_docs(docs).collect()) == [0, 1]


def test_densified_signatures():
    rng = np.random.default_rng(1)
    for n in (1, 2, 10, 1000):
        hashes = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1))
        found = near_dup.signature(hashes)
        assert set(found) <= set(hashes)
    a = np.unique(rng.integers(0, 1 << 63, 2000).astype(np.uint64) << np.uint64(1))
    b = np.unique(np.concatenate([a[::2], rng.integers(0, 1 << 63, 1000).astype(np.uint64) << np.uint64(1)]))
    agree = (near_dup.signature(a) == near_dup.signature(b)).mean()
    assert 0.15 < agree < 0.55  # a third in common


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 50 + i) for i in range(5)] + [(7, 7), (201, 200), (200, 201)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {i: 1 for i in range(1, 41)} | {i: 50 for i in (50, 51, 52, 53, 54, 100)} | {200: 200, 201: 200}


def test_one_document_of_each_group_stays_whatever_the_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    near = [f"{words} end{i}" for i in range(4)]
    rows = [(None, near[0], "en", "a", 0), (None, near[1], "en", "a", 0), (None, "alone here", "en", "a", 0)]
    kept = [r.text for r in near_dup.stage_docs(make_docs(spark, rows)).collect()]
    assert len(kept) == 2 and "alone here" in kept
    rows = [(5, t, "en", "a", 0) for t in near] + [(None, near[0], "en", "a", 0), (9, near[1], "en", "a", 0)]
    kept = near_dup.stage_docs(make_docs(spark, rows)).collect()
    assert [r.doc_id for r in kept] == [5]
    rows = [(None, "", "en", "a", 0), (None, None, "en", "a", 0), (3, "", "en", "a", 0)]
    assert near_dup.stage_docs(make_docs(spark, rows)).count() == near_dup.stage_docs(make_docs(spark, rows[::-1])).count()


def test_memory_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(near_dup, "_REMEMBERED_BYTES", 1000)
    memory = near_dup._WordHashes()
    for i in range(1000):
        assert memory[b"%d" % i] == memory[b"%d" % i]
        assert len(memory) < 10
    assert memory[b"x" * 65] and b"x" * 65 not in memory

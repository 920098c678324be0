from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.helpers import ODD, make_docs
from tomeworks.llm import quality_rules as q


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines), sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated)


def test_counts():
    texts = ["a b c d e " * 3, "x\nx\n\n \nx y\x0bz w", "#a *b\n#a *b", "", "a b a b a b a b", "\x1c \x85 word"]
    for text in texts + [row[1] for row in ODD if row[1] and len(row[1]) < 1000]:
        assert q.count_words(text) == plain_counts(text), text


def test_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = q.op4_quality_rules(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, _, dup, repeated = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (r.base_failed and r.kept)


GOOD = "the quick brown fox number {i} runs over lazy dogs and {j} cats while nobody is looking at it"
BAD = "the### quick*** brown%%% fox$$$ {i} runs### over*** lazy%%% dogs$$$ and {j}### cats***"


def fill(form, n, lang, source, start):
    return [(start + i, form.format(i=i, j=7 * i), lang, source, 0) for i in range(n)]


def test_limits_follow_the_group(spark):
    rows = fill(GOOD, 200, "en", "clean", 0) + fill(BAD, 20, "en", "clean", 1000)
    rows += fill(BAD, 200, "en", "tables", 2000)  # a source where symbols are usual
    rows += fill(BAD, 3, None, None, 3000)  # too small a group: judged by all
    kept = {r.doc_id: r.kept for r in q.judge(make_docs(spark, rows)).collect()}
    assert len(kept) == len(rows)
    assert all(kept[i] for i in range(200))
    assert not any(kept[1000 + i] for i in range(20))
    assert all(kept[2000 + i] for i in range(200))


def plain_kept(rows):
    """Verdicts of (doc_id, text, lang, source, ...) from sorted values instead of sketches."""
    measures = {}
    for i, text, *_ in rows:
        n, chars, symbols, lines, dup, repeated = plain_counts(text)
        words = max(n, 1)
        measures[i] = (1000 * symbols // max(chars, 1), 1000 * dup // max(lines, 1), 1000 * repeated // words, 10 * chars // words)

    def limits(ids):
        found = []
        for k in range(4):
            held = sorted(math.exp(round(math.log(measures[i][k] + 1) * q.BINS) / q.BINS) - 1 for i in ids)
            low, mid, high = (held[math.ceil(len(held) * share) - 1] for share in (0.1, 0.5, 0.75))
            found.append((mid, q.SPREAD * max(mid - low, high - mid)))
        return found

    kept = {}
    for i, text, lang, source, *_ in rows:
        groups = [[r[0] for r in rows if r[2:4] == (lang, source)], [r[0] for r in rows if r[2] == lang]]
        ids = next((g for g in groups if len(g) >= q.SUPPORT), [r[0] for r in rows])
        (a, b, c, (mid, spread)), (x, y, z, length) = limits(ids), measures[i]
        over = any(v > m + s + e for v, (m, s), e in zip((x, y, z), (a, b, c), (20, 150, 100)))
        n, _, _, _, _, repeated = plain_counts(text)
        kept[i] = not (n < 10 or 5 * repeated > n or over or abs(length - mid) > spread + 10)
    return kept


def test_verdicts_of_the_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs]
    assert {r.doc_id: r.kept for r in q.op4_quality_rules(spark, folder).collect()} == plain_kept(rows)


def test_a_clean_group_is_judged_strictly(spark):
    """Below any usual fixed cutoff: 5 % symbols, a fifth of repeated lines, an eighth of repeated phrases."""
    rows = fill(GOOD, 300, "en", "clean", 0)
    words = " ".join(f"word{i} goes" for i in range(60))
    phrase = "one two three four five"
    rows.append((1000, words.replace(" goes", "# goes#", 10), "en", "clean", 0))
    rows.append((1001, "\n".join([f"this is line {i} of some text" for i in range(8)] + ["this is line 1 of some text"] * 2), "en", "clean", 0))
    rows.append((1002, f"{phrase} {words[:300]} {phrase}", "en", "clean", 0))
    rows.append((1003, " ".join(["extraordinarily", "internationalization"] * 10 + [str(i) * 15 for i in range(9)]), "en", "clean", 0))
    rows.append((1004, " ".join(chr(97 + i % 26) + chr(97 + i // 26) for i in range(50)), "en", "clean", 0))
    kept = {r.doc_id: r.kept for r in q.judge(make_docs(spark, rows)).collect()}
    assert kept == plain_kept(rows)
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(5))


def test_sketches_merge(spark):
    rows = fill(GOOD, 60, "en", "a", 0) + fill(BAD, 60, "en", "b", 100)
    counted = q.measured(make_docs(spark, rows))
    whole = {tuple(r) for r in q.sketches(counted).drop("source").groupBy("lang", "measure", "bin").agg(F.sum("n")).collect()}
    halves = q.sketches(counted.where("doc_id % 2 = 0")).unionByName(q.sketches(counted.where("doc_id % 2 = 1")))
    assert whole == {tuple(r) for r in halves.groupBy("lang", "measure", "bin").agg(F.sum("n")).collect()}


def test_odd_rows(spark):
    docs = make_docs(spark, ODD).withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit("clash"))
    rows = q.judge(docs).collect()
    assert len(rows) == len(ODD)
    assert all(r.base_failed for r in rows if not (r.text or "").strip())
    assert q.judge(docs.limit(0)).count() == 0


def test_large_limit_table_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tomeworks.llm.common.BROADCAST_ROWS", 0)
    rows = fill(GOOD, 60, "en", "a", 0) + fill(BAD, 10, "en", "a", 100)
    assert [r.doc_id for r in q.judge(make_docs(spark, rows)).collect() if not r.kept] != []

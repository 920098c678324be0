from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, folder_of, make_docs
from tomeworks.llm import divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute_force(rows, least, top):
    """Every share of every term, sorted whole."""
    words = lambda text: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        found = words(text or "")
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(found)
        in_docs[lang].update(set(found))
    result = set()
    for lang, sources in groups.items():
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        share = lambda n, total: 1 + 10**9 * (n + 2) // (total + 2 * len(kept))
        p = {}
        for source in sources:
            total = sum(counts[lang, source][t] for t in kept)
            p[source] = {t: share(counts[lang, source][t], total) for t in kept}
        everything = sum((counts[lang, s] for s in sources), Counter())
        total = sum(everything[t] for t in kept)
        q = {t: share(everything[t], total) for t in kept}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for source in sources:
            terms = [(f(p[source][t], q[t]), t) for t in kept if counts[lang, source][t] and p[source][t] > q[t]]
            pairs = [(sum(f(p[source][t], p[o][t]) for t in kept), o) for o in sources if o != source]
            for part, scored, limit in (("term", terms, top), ("pair", pairs, None)):
                scored.sort(key=lambda x: (-x[0], x[1].encode()))
                result |= {(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(scored[:limit])}
    return result


def rows_of(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("least", [1, 3])
def test_odd_rows(spark, least):
    rows = [*ODD, *[(50 + i, f"The the ÉTÉ été_x2y 漢字 🙂 {i}", "en", "c", 1) for i in range(3)]]
    docs = make_docs(spark, rows).withColumns({c: F.lit(1) for c in ("term", "n", "item", "value", "terms")})
    assert rows_of(divergence.audit(docs, least, 4)) == brute_force(rows, least, 4)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_many_groups_with_equal_values_and_a_hot_source(spark):
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcé漢z", k=3)) for _ in range(60)]
    rows = []
    for i in range(400):
        lang = draw.choice(["en", "fr", None])
        source = "hot" if i % 3 == 0 else f"s{draw.randrange(6)}"
        rows.append((i, " ".join(draw.choices(vocabulary, k=draw.randrange(12))), lang, source, 1))
    rows += [(900 + i, "", "xx", f"s{i}", 0) for i in range(3)] + [(950, "only once", "en", "new", 9)]
    got = rows_of(divergence.audit(make_docs(spark, rows), 10, 10))
    assert got == brute_force(rows, 10, 10)
    assert {r[4] for r in got if r[0] == "xx"} == {0}


def test_shares_of_huge_counts_are_exact(spark):
    n, total, kept = 3 * 10**15 + 7, 9 * 10**17 + 11, 10**9 + 1
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept))).first()
    assert row[0] == 1 + 10**9 * (n + 2) // (total + 2 * kept)


def test_query(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, 0) for r in docs]
    assert rows_of(divergence.op12_source_divergence(spark, folder)) == brute_force(rows, 10, 10)
    odd = folder_of(tmp_path, spark, make_docs(spark, ODD))
    assert rows_of(divergence.op12_source_divergence(spark, odd)) == brute_force(ODD, 10, 10)

"""Source divergence audit: how the terms of a source differ from the other sources of its language.

Every language keeps the terms that enough of its documents have.  A group is a
(language, source) that occurs.  Both a group and a language give each kept term
a smoothed share p in billionths, from its occurrences there; two shares differ
by f = floor((p - q)^2 / (p + q)).  All numbers are integers.

*Terms of a group*, by count-cell ranking.  f depends on a term only through its
cell, the counts in the group and in the language, and there are far fewer cells
than terms.  f is evaluated once a cell, cells of one value are merged, and
merged cells are ranked by the cumulated number of their terms.  Only
cells that begin within the wanted ranks are expanded to terms, in the order of
their UTF-8 bytes; a cell of very many terms is cut to the wanted number in
every task before it is exchanged.

*Pairs of sources* sum f over all kept terms.  Of every term only the sources
that have it are written, as one array; equal arrays are counted once.  Cells
(count in one, count in the other) of terms that both have are counted from
these arrays, and all other terms follow from the count histogram of each
source.  The work for a term grows with the square of the number of sources that have it,
as does the result with the number of sources.

Null text, language and source count as ''.  Repeated rows are documents of
their own.  A group without kept terms has a share of 1 + 2/(2V) for each; a
language without kept terms has pairs of value 0 and no term rows.  Texts may
have any length; an empty table gives an empty result.  Ids and other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomeworks.llm.common import documents, query
from tomeworks.staging import stage

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
# Everything but ASCII letters and characters beyond ASCII parts two terms.
_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Of the bytes of a text, letters in lower case and those beyond ASCII stay, all others become spaces.
_TERM_BYTES = bytes(b if b > 0x7F or chr(b).isalpha() else 0x20 for b in range(256)).lower()
_COUNTED = 400_000
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_WIDE = "decimal(38,0)"


def _group() -> list[Column]:
    return [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * kept)), exactly, however large the counts are."""
    parts = F.lit(UNIT).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + 2)
    whole_of = total.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)") * kept.cast("decimal(20,0)")
    return F.call_function("div", parts, whole_of).cast("bigint") + 1


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most UNIT + 1, so the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def group_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that have the term; one exchange.

    A task counts up to _COUNTED (group, term) pairs before it passes them on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}
        held = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in found.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                columns = [[lang] * len(n), [source] * len(n), terms, list(n.values()), [in_docs[t] for t in n]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_COUNTS)
            found.clear()

        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
                terms = text.translate(_TERM_BYTES).split()
                n, in_docs = found.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                n.update(terms)
                in_docs.update(set(terms))
                held += len(n)
                if held > _COUNTED:
                    yield from counted()
                    held = 0
        yield from counted()

    texts = docs.select(*_group(), F.coalesce("text", F.lit("")).cast("binary"))
    counts = texts.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    # counted already: exchanged by term, so that the sources of a term need not move again
    return counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, n, sources): kept terms, their occurrences in the language, and array<(source, n)> by source."""
    return (
        group_terms(docs)
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("n"),
            F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources"),
        )
        .where(F.col("docs") >= least_documents)
        .drop("docs")
    )


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, n_lang, kept): of every group the occurrences of kept terms, there and in the
    language, and the number of kept terms; one row a group."""
    groups = docs.select(*_group()).distinct()
    own = (
        kept.select("lang", F.inline("sources"))
        .groupBy("lang", "source")
        .agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    )
    langs = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count("*").alias("kept"))
    found = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    return found.fillna(0, ["total", "present", "n_lang", "kept"])


def term_ranking(kept: DataFrame, totals: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): of every group the terms it uses more than its language, up to rank ``top``."""
    entries = kept.select("lang", "term", F.col("n").alias("all"), F.inline("sources"))
    cells = entries.groupBy("lang", "source", "n", "all").agg(F.count("*").alias("terms"))
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("all"), F.col("n_lang"), F.col("kept"))
    valued = (
        cells.join(totals, ["lang", "source"])
        .withColumns({"p": p, "q": q})
        .where("p > q")
        .withColumn("value", difference(F.col("p"), F.col("q")))
    )
    merged = valued.groupBy("lang", "source", "value").agg(
        F.sum("terms").alias("terms"), F.collect_list(F.struct("n", "all")).alias("members")
    )
    above = (
        Window.partitionBy("lang", "source").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    )
    begun = merged.withColumn("above", F.coalesce(F.sum("terms").over(above), F.lit(0))).where(F.col("above") < top)
    wanted = stage(begun.select("lang", "source", "value", "above", F.inline("members")), "cells")
    listed = entries.join(wanted, ["lang", "source", "n", "all"])
    order = Window.partitionBy("lang", "source", "value").orderBy("term")
    # the bound on the place lets every task keep its first terms only
    first = listed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    rank = (F.col("above") + F.col("place")).cast("int")
    return first.select("lang", "source", F.col("term").alias("item"), "value", rank.alias("rank")).where(
        F.col("rank") <= top
    )


def pair_values(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value): the differences of all ordered pairs of sources of a language."""
    s, t = totals.alias("s"), totals.alias("t")
    pairs = s.join(t, (F.col("s.lang") == F.col("t.lang")) & (F.col("s.source") < F.col("t.source")))
    pairs = stage(
        pairs.select(
            "s.lang", "s.kept", F.col("s.source").alias("a"), F.col("t.source").alias("b"),
            F.col("s.total").alias("total_a"), F.col("t.total").alias("total_b"),
            F.col("s.present").alias("present_a"), F.col("t.present").alias("present_b"),
        ),
        "source-pairs",
    )
    by = ["lang", "a", "b"]

    def f(in_a: Column, in_b: Column) -> Column:
        return difference(
            share(in_a, F.col("total_a"), F.col("kept")), share(in_b, F.col("total_b"), F.col("kept"))
        ).cast(_WIDE)

    none = F.lit(0)
    # terms that both have
    profiles = kept.groupBy("lang", "sources").agg(F.count("*").alias("terms"))
    couples = F.expr(
        "flatten(transform(sources, (x, i) -> transform(slice(sources, i + 2, size(sources)),"
        " y -> struct(x.source as a, y.source as b, x.n as in_a, y.n as in_b))))"
    )
    both = (
        profiles.select("lang", "terms", F.inline(couples))
        .groupBy(*by, "in_a", "in_b")
        .agg(F.sum("terms").alias("terms"))
        .join(pairs, by)
    )
    a, b = F.col("in_a"), F.col("in_b")
    corrected = both.select(*by, (F.col("terms") * (f(a, b) - f(a, none) - f(none, b) + f(none, none))).alias("value"))
    # terms of each source, as if the other had none of them
    histogram = stage(
        kept.select("lang", F.inline("sources")).groupBy("lang", "source", "n").agg(F.count("*").alias("terms")),
        "histogram",
    )
    sides = []
    for side in "ab":
        joined = histogram.withColumnRenamed("source", side).join(pairs, ["lang", side])
        value = f(F.col("n"), none) if side == "a" else f(none, F.col("n"))
        sides.append(joined.select(*by, (F.col("terms") * value).alias("value")))
    # terms of neither
    rest = F.col("kept") - F.col("present_a") - F.col("present_b")
    absent = F.when(F.col("kept") > 0, rest * f(none, none)).otherwise(F.lit(0).cast(_WIDE))
    parts = pairs.select(*by, absent.alias("value")).unionByName(corrected)
    for side in sides:
        parts = parts.unionByName(side)
    summed = stage(parts.groupBy(*by).agg(F.sum("value").cast("bigint").alias("value")), "pair-values")
    there = summed.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    back = summed.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    return there.unionByName(back)


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has all other sources, part ``term`` the first terms."""
    kept = stage(kept_terms(docs, least_documents), "kept-terms")
    totals = stage(group_totals(docs, kept), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(kept, totals).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    terms = term_ranking(kept, totals, top).withColumn("part", F.lit("term"))
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.select(*columns))


@query
def op12_source_divergence(spark, folder):
    return audit(documents(spark, folder))


SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term
  FROM documents
),
kept AS (SELECT lang, term, count(*) AS n FROM docs GROUP BY ALL HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
counts AS (SELECT lang, source, term, count(*) AS n FROM docs SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY ALL),
totals AS (
  SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
),
shares AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 2)) // (t.total + 2 * l.v) AS p,
         1 + ({UNIT}::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
pair AS (
  SELECT g.lang, g.source, o.source AS item,
         coalesce(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)), 0) AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN shares a ON a.lang = g.lang AND a.source = g.source
  LEFT JOIN shares b ON b.lang = o.lang AND b.source = o.source AND b.term = a.term
  GROUP BY ALL
),
term AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', item, CAST(value AS BIGINT),
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM term QUALIFY rank <= {TOP_TERMS}
"""

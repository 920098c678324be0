"""Quality rules with thresholds learned per language and source.

Every document is measured (word, symbol, repeated-line and repeated-phrase
counts).  The shares made from the counts go into quantile sketches, one per
language, source and measure.  A sketch is a histogram over logarithmic bins:
two of them merge by adding counts, so the result does not depend on how rows
are spread or in which order partial sketches meet, and any quantile is exact
to about 1.6 % of its value.  A sketch never has more than some 700 bins.

From the sketches come the limits, in both directions: the median and SPREAD times
the distance to the 10 % or the 75 % quantile, whichever is more, and a small margin, as most
groups have no symbols or repeated lines at all.  A quarter of a group may be bad
without moving its limits.  A group of fewer than SUPPORT documents takes the merged sketch of its
language, and a language with few documents that of all.  Limits are joined to
the documents by language and source, null being a group like any other.

Null, empty and blank texts have no words and fail the base rule.  Rows are
judged one by one, so repeated rows get the same verdict.  An empty table gives
an empty result.  Columns named like the results are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomeworks.llm.common import documents, query, small_join, whole
from tomeworks.staging import stage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"
_PHRASE = 5

BINS = 32  # per unit of the natural logarithm
SPREAD = 4
SUPPORT = 50
# Per thousand: symbols to word characters, repeated lines to lines, words in repeated phrases to words.
MARGINS = {"symbol_share": 20, "dup_line_share": 150, "repeat_share": 100}
LENGTH_MARGIN = 10  # tenths of a character of the mean word length, on either side
MEASURES = (*MARGINS, "word_length")


def count_words(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    words = text.encode(errors="replace").split()
    blanks = sum(map(text.count, _BLANKS))
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    repeated = 0
    phrases = list(zip(*(words[i:] for i in range(_PHRASE))))
    if len(set(phrases)) < len(phrases):
        seen, twice = set(), set()
        for phrase in phrases:
            (twice if phrase in seen else seen).add(phrase)
        upto = 0  # words before this one are counted
        for i, phrase in enumerate(phrases):
            if phrase in twice:
                repeated += i + _PHRASE - max(i, upto)
                upto = i + _PHRASE
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), len(text) - blanks, symbols, len(lines), len(lines) - len(set(lines)), repeated


def _counted(texts: pa.Array) -> pa.Array:
    rows = [count_words(text or "") for text in texts.to_pylist()]
    columns = zip(*rows) if rows else [[] for _ in COUNTS]
    return pa.StructArray.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=list(COUNTS))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``_counts``."""
    counted = F.arrow_udf(_counted, ", ".join(f"{name} bigint" for name in COUNTS))
    return docs.withColumn("_counts", counted(whole(F.col("text"))))


def _share(part: str, of: str, times: int) -> Column:
    return F.floor(F.lit(times) * F.col(f"_counts.{part}") / F.greatest(F.col(f"_counts.{of}"), F.lit(1)))


def _measure_columns() -> dict[str, Column]:
    return {
        "symbol_share": _share("n_symbols", "word_chars", 1000),
        "dup_line_share": _share("n_dup_lines", "n_lines", 1000),
        "repeat_share": _share("n_repeat_words", "n_words", 1000),
        "word_length": _share("word_chars", "n_words", 10),
    }


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): bounded per group, summed on the map side."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("value")) for m, v in _measure_columns().items()])
    rows = counted.select("lang", "source", F.inline(values))
    place = F.round(F.log(F.col("value") + 1) * BINS).cast("int")
    return rows.groupBy("lang", "source", "measure", place.alias("bin")).agg(F.count("*").alias("n"))


def _limits(sketch: DataFrame, level: list[str]) -> DataFrame:
    """One row per group of the level: _n and a limit per measure."""
    merged = sketch.groupBy(*level, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*level, "measure")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = merged.select(*level, "measure", "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("all"))

    def quantile(share: float) -> Column:
        at = F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("bin")))
        return F.exp(at / BINS) - 1

    limits = placed.groupBy(*level, "measure").agg(
        F.max("all").alias("n"), quantile(0.1).alias("low"), quantile(0.5).alias("mid"), quantile(0.75).alias("high")
    )
    of = lambda m, value: F.max(F.when(F.col("measure") == m, value))
    spread = SPREAD * F.greatest(F.col("mid") - F.col("low"), F.col("high") - F.col("mid"))
    return limits.groupBy(*level).agg(
        F.max("n").alias("_n"),
        F.struct(
            *[of(m, F.col("mid") + spread + margin).alias(m) for m, margin in MARGINS.items()],
            of("word_length", F.col("mid") - spread - LENGTH_MARGIN).alias("shortest"),
            of("word_length", F.col("mid") + spread + LENGTH_MARGIN).alias("longest"),
        ).alias("_limit"),
    )


def limits(sketch: DataFrame) -> DataFrame:
    """(_lang, _source, _limit): one row per language and source, from the narrowest group with support."""
    narrow = _limits(sketch, ["lang", "source"])
    by_lang = _limits(sketch, ["lang"]).select(F.col("lang").alias("_l"), F.col("_n").alias("_ln"), F.col("_limit").alias("_ll"))
    overall = _limits(sketch.withColumn("one", F.lit(1)), ["one"]).select("one", F.col("_limit").alias("_all"))
    both = narrow.join(by_lang, F.col("lang").eqNullSafe(F.col("_l"))).withColumn("one", F.lit(1)).join(overall, "one")
    chosen = F.when(F.col("_n") >= SUPPORT, F.col("_limit")).when(F.col("_ln") >= SUPPORT, F.col("_ll")).otherwise(F.col("_all"))
    return both.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), chosen.alias("_limit"))


def judged(counted: DataFrame) -> DataFrame:
    """``counted`` (a stage table with ``_counts``) with the counts, base_failed and kept."""
    table = stage(limits(stage(sketches(counted), "sketches")), "limits")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    rows = small_join(counted, table, table.count(), same, "left")
    count = lambda name: F.col(f"_counts.{name}")
    base = (count("n_words") < 10) | (100 * count("n_repeat_words") > 20 * count("n_words"))
    value = _measure_columns()
    fine = F.lit(True)
    for m in MARGINS:
        fine = fine & (value[m] <= F.col(f"_limit.{m}"))
    fine = fine & value["word_length"].between(F.col("_limit.shortest"), F.col("_limit.longest"))
    names = [c for c in counted.columns if c not in (*COUNTS, "_counts", "base_failed", "kept")]
    return rows.select(
        *names,
        *[count(c).alias(c) for c in COUNTS],
        base.alias("base_failed"),
        (~base & fine).alias("kept"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with its counts and verdict; counted once, then read from a stage table."""
    return judged(stage(measured(docs), "counted"))


def stage_docs(docs: DataFrame) -> DataFrame:
    """For a pipeline: the documents that are kept, with their own columns."""
    rows = measured(docs.select(F.struct("*").alias("_row"), "lang", "source", "text")).drop("text")
    return judged(stage(rows, "counted")).where("kept").select("_row.*")


@query
def op4_quality_rules(spark, folder):
    docs = measured(documents(spark, folder).select("doc_id", "lang", "source", "text")).drop("text")
    return judged(stage(docs, "counted")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

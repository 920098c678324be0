"""Secrets in text, by built-in functions only.

Four kinds of spans, in code points, end exclusive.  Three are patterns: an
assignment to a telling name, an access key, a long run of hex digits.  The
fourth comes from entropy: a candidate is a run of 20 or more characters usual
in keys that has both letters and digits.  A window of 20 characters slides over it; the
counts of the characters in the window and the sum of count x log2(count) are
carried from step to step, one character entering and one leaving, and so are its numbers of hex digits and of decimals.
A window of hex digits that are not all decimals, or of other key characters, is a hit from a limit of its own class.
The span reaches from the first hit of the candidate to the last; it is of kind entropy_hex if all hits were.  Windows
that touch a match of the allow list (UUIDs, paths of words, placeholders) are suppressed, the other windows of the candidate are not;
the list never touches the three patterns.

Null text counts as empty; no spans give an empty string.  Each row is scanned
by itself, whatever its length: no shuffle, no rows multiplied.  Matches are placed in blocks of STEPS,
so the work does not grow with the square of their number.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.llm.common import documents, query, whole
from tomeworks.operators.fence import computed_once

# Pattern, group whose length counts, least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_KINDS = {
    "assign": (ASSIGN, 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}

WINDOW = 20
HEX_LIMIT, KEY_LIMIT = 3.0, 3.75  # bits per character
_KEY = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{_KEY}])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[{_KEY}]{{{WINDOW},}}+"
# decimals, other hex digits, other key characters, and the mark of a suppressed character
_ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=- "
_DECIMALS, _HEX_DIGITS = 10, 22
STEPS = 512

_NAME = r"[A-Z]?[a-z]{2,}(?:[A-Z][a-z]+)*[0-9]{0,4}(?:[_-][A-Z]?[a-z]*[0-9]{0,4})*"
ALLOWED = (
    r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-fA-F])",
    rf"(?:/{_NAME}|(?<![A-Za-z0-9+]){_NAME}/{_NAME})(?:/{_NAME})+(?![A-Za-z0-9+])",
    r"(?i:example|placeholder|dummy|changeme)",
    r"([A-Za-z0-9+/_=-])\1{7,}",
    r"(?i:0123456789|abcdefghij)",
)

_SPAN = "array<struct<start:bigint,rank:int,kind:string,stop:bigint>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _placed(text: Column, pattern: str, quick: str, span: Callable[[Column, Column], Column]) -> Column:
    """Spans of the matches of a pattern; ``span`` makes the array of spans from a match and its start.

    The pieces between the matches and the matches themselves give every start as a running sum of lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece).cast("bigint"))
    pairs = F.zip_with(gaps, found, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    zero = F.lit(0).cast("bigint")

    def step(state: Column, pair: Column) -> Column:
        match = F.coalesce(pair["match"], F.lit(""))
        at = state["at"] + pair["gap"]
        more = F.when(F.length(match) > 0, span(match, at)).otherwise(_none())
        return F.struct(
            (at + F.length(match)).alias("at"),
            F.when(F.size(more) > 0, F.concat(state["spans"], more)).otherwise(state["spans"]).alias("spans"),
        )

    def in_blocks(pairs: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(pairs), F.lit(STEPS))
        begin = F.struct(zero.alias("at"), _none().alias("spans"))
        return F.transform(starts, lambda i: F.aggregate(F.slice(pairs, i, STEPS), begin, step))

    def flat(blocks: Column) -> Column:
        begin = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("before"))
        add = lambda sums, block: F.struct(
            (sums["at"] + block["at"]).alias("at"), F.concat(sums["before"], F.array(sums["at"])).alias("before")
        )
        before = F.aggregate(blocks, begin, add, lambda sums: sums["before"])
        return F.flatten(F.zip_with(blocks, before, lambda block, at: F.transform(block["spans"], lambda x: _moved(x, at))))

    return F.when(text.rlike(quick), _bound(_bound(pairs, in_blocks), flat)).otherwise(_none())


def _bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is computed once, however often the function names it."""
    return F.get(F.transform(F.array(value), function), 0)


def _moved(span: Column, by: Column) -> Column:
    return F.struct((span["start"] + by).alias("start"), span["rank"], span["kind"], (span["stop"] + by).alias("stop"))


def _one(kind: str, rank: int, start: Column, stop: Column) -> Column:
    return F.array(
        F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), stop.alias("stop"))
    ).cast(_SPAN)


def base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = BASE_KINDS[kind]
    rank = list(BASE_KINDS).index(kind)

    def span(match: Column, at: Column) -> Column:
        long_enough = F.length(F.regexp_extract(match, pattern, group)) >= least
        return F.when(long_enough, _one(kind, rank, at, at + F.length(match))).otherwise(_none())

    # a longer run is asked for first where that cannot change what is found
    quick = {"assign": pattern, "access": r"AKIA[A-Z0-9]{14}", "hex": r"[0-9a-f]{16}"}[kind]
    return _placed(text, pattern, quick, span)


def _unsuppressed(candidate: Column, allowed: Sequence[str]) -> Column:
    """The candidate with blanks for what the allow list matches."""
    if not allowed:
        return candidate
    pattern = "|".join(f"(?:{p})" for p in allowed)
    blanks = F.transform(F.regexp_extract_all(candidate, F.lit(pattern), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
    pieces = F.zip_with(F.split(candidate, pattern, -1), blanks, lambda piece, blank: F.concat(piece, F.coalesce(blank, F.lit(""))))
    return F.when(candidate.rlike(pattern), F.array_join(pieces, "")).otherwise(candidate)


def _hot_windows(candidate: Column, hex_limit: float, key_limit: float) -> Column:
    """struct(first, last, all_hex): the ends of the first and last hit, and whether all hits were of hex digits; null without one."""
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(_ALPHABET), c))
    past = F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), codes), F.lit(1), F.size(codes))
    steps = F.zip_with(codes, past, lambda enters, leaves: F.struct(enters.alias("enters"), leaves.alias("leaves")))
    # count x log2(count) for a count of 0 to WINDOW
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)])
    of = lambda count: F.element_at(weight, count + 1)
    start = F.struct(
        F.array_repeat(F.lit(0), len(_ALPHABET)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
        F.lit(True).alias("all_hex"),
        F.lit(0).alias("decimals"),
        F.lit(0).alias("hexes"),
    )
    within = lambda code, most: F.when(code.between(1, most), 1).otherwise(0)

    def step(state: Column, x: Column) -> Column:
        # one leaves, then one enters; both may be the same character
        counts = state["counts"]
        leaving = F.when(x["leaves"] > 0, F.get(counts, x["leaves"] - 1)).otherwise(F.lit(1))
        entering = F.get(counts, x["enters"] - 1) - F.when(x["leaves"] == x["enters"], 1).otherwise(0)
        total = state["total"] - of(leaving) + of(leaving - 1) - of(entering) + of(entering + 1)
        changed = F.transform(
            counts,
            lambda n, i: n
            + F.when(i == x["enters"] - 1, 1).otherwise(0)
            - F.when(i == x["leaves"] - 1, 1).otherwise(0),
        )
        at = state["at"] + 1
        # sums of doubles differ in the last bits from one order to another
        decimals, hexes = (
            state[name] + within(x["enters"], most) - within(x["leaves"], most)
            for name, most in (("decimals", _DECIMALS), ("hexes", _HEX_DIGITS))
        )
        is_hex = (hexes == WINDOW) & (decimals < WINDOW)
        limit = F.when(is_hex, hex_limit).otherwise(key_limit)
        bits = F.lit(math.log2(WINDOW)) - total / WINDOW
        hot = (at >= WINDOW) & (F.element_at(changed, -1) == 0) & (bits >= limit - 1e-9)
        return F.struct(
            changed.alias("counts"),
            total.alias("total"),
            at.alias("at"),
            F.coalesce(state["first"], F.when(hot, at)).alias("first"),
            F.when(hot, at).otherwise(state["last"]).alias("last"),
            (state["all_hex"] & (~hot | is_hex)).alias("all_hex"),
            decimals.alias("decimals"),
            hexes.alias("hexes"),
        )

    return F.aggregate(steps, start, step, _ends)


def _ends(state: Column) -> Column:
    return F.when(state["first"].isNotNull(), F.struct(*[state[c].alias(c) for c in ("first", "last", "all_hex")]))


def entropy_spans(text: Column, allowed: Sequence[str] = ALLOWED, hex_limit: float = HEX_LIMIT, key_limit: float = KEY_LIMIT) -> Column:
    def span(match: Column, at: Column) -> Column:
        hot = _hot_windows(_unsuppressed(match, allowed), hex_limit, key_limit)
        ends = F.filter(F.array(hot), lambda x: x.isNotNull())
        spans = F.transform(
            ends,
            lambda x: F.struct(
                (at + x["first"] - WINDOW).cast("bigint").alias("start"),
                F.lit(len(BASE_KINDS)).alias("rank"),
                F.when(x["all_hex"], "entropy_hex").otherwise("entropy_key").alias("kind"),
                (at + x["last"]).cast("bigint").alias("stop"),
            ),
        )
        return spans.cast(_SPAN)

    return _placed(text, CANDIDATE, CANDIDATE, span)


def find_secrets(docs: DataFrame, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``docs`` with one array of spans (start, rank, kind, stop) per kind: assign, access, hex, entropy.

    Columns of these names are replaced.
    """
    kinds = {kind: base_spans(F.col("_text"), kind) for kind in BASE_KINDS}
    kinds["entropy"] = entropy_spans(F.col("_text"), allowed)
    others = [c for c in docs.columns if c not in kinds]
    fenced = computed_once(docs.withColumn("_text", whole(F.col("text"))), others, **kinds)
    return fenced.select(*others, *kinds)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans by start, then kind."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


@query
def op2_secret_scan(spark, folder):
    found = find_secrets(documents(spark, folder).select("doc_id", "text")).drop("text")
    base = F.concat(*BASE_KINDS)
    return found.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, F.col("entropy"))).alias("spans"),
    )

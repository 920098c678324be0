"""Language of a text, and of its parts when languages are mixed.

A word is a run of letters.  The script of its first letter, by code ranges, narrows the languages to
those whose training words use that script.  Its score for a language is the
sum of the log probabilities of its character n-grams (1 to 4, with word ends),
hashed to a fixed number of buckets.  A Viterbi search then labels the words
of a text: staying in a language is free, changing costs SWITCH.  Stretches
of one label are the spans; the language with most letters is the prediction,
its share of the letters the score.

The model is learned from a bounded sample: at most about SAMPLE labelled rows
of each language, chosen by a hash of id and text.  Its size is buckets times
languages, whatever the corpus.  Prediction is one row's work, whole
texts, no shuffle; many texts go through the search side by side.

Null texts and texts without a letter are ``und`` with score 0; so is every text
when there is nothing to learn from.  Ties go to the name that sorts first.
Repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.llm.common import documents, query, whole

SAMPLE = 5_000
BUCKETS = 1 << 15
SWITCH = 8.0
NONE = "und"
_LONGEST_GRAM = 4
_REMEMBERED = 200_000
_NEW_WORDS = 20_000  # scored at a time
_TRELLIS = 1 << 24  # cells of one search
_CHARS = 2_000_000  # of the texts searched together; a longer text is searched alone
_WORD = re.compile(r"[^\W\d_]+")

# First code point of each range and its script; fixed values.
SCRIPTS = [
    (0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x900, "devanagari"), (0x980, "other"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0x10000, "other"), (0x20000, "han"),
]
_STARTS = np.array([start for start, _ in SCRIPTS])
_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(name) for _, name in SCRIPTS])
# A script belongs to a language when this share of its words, or more, are written in it.
_SCRIPT_SHARE = 0.01


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of every word."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    owners, buckets = [], []
    total = np.zeros(len(codes), np.uint64)
    for n in range(1, _LONGEST_GRAM + 1):
        valid = len(codes) - n + 1
        if valid <= 0:
            break
        total = (total[:valid] + codes[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(31)
        inside = owner[:valid] == owner[n - 1 :]
        owners.append(owner[:valid][inside])
        buckets.append((total[inside] >> np.uint64(7)) % np.uint64(BUCKETS))
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


def scripts(words: list[str]) -> np.ndarray:
    first = np.array([ord(w[0]) for w in words])
    return _SCRIPT[np.searchsorted(_STARTS, first, side="right") - 1]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n): n-gram counts, and after the buckets the counts of words by script."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            words.setdefault(lang.as_py(), Counter()).update(_WORD.findall(text.as_py().lower()))
        for lang, counter in words.items():
            if counter:
                total = totals.setdefault(lang, np.zeros(BUCKETS + len(_NAMES)))
                own, times = list(counter), np.array(list(counter.values()), float)
                owner, bucket = grams(own)
                total[:BUCKETS] += np.bincount(bucket, times[owner], BUCKETS)
                total[BUCKETS:] += np.bincount(scripts(own), times, len(_NAMES))
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at), pa.array(total[at].astype(np.int64))], names=["lang", "slot", "n"]
        )


def sampled(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` rows of each language at most; the rows depend on nothing but id, text and the counts."""
    sizes = labelled.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    rows = labelled.join(F.broadcast(sizes), F.col("lang") == F.col("_lang"))  # one row per language
    return rows.where(draw * F.col("_n") < sample).select("lang", "text")


class Model:
    def __init__(self, counts: dict[str, np.ndarray], switch: float = SWITCH):
        self.langs = sorted(counts)
        self.switch = switch
        table = np.array([counts[lang] for lang in self.langs]).reshape(-1, BUCKETS + len(_NAMES))
        ngrams, words = table[:, :BUCKETS] + 0.5, table[:, BUCKETS:]
        self.logs = np.log(ngrams / ngrams.sum(axis=1, keepdims=True))
        self.uses = words >= _SCRIPT_SHARE * words.sum(axis=1, keepdims=True)
        self._ready()

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("langs", "switch", "logs", "uses")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _ready(self):
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.langs)), np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        owner, bucket = grams(words)
        found = np.stack([np.bincount(owner, logs[bucket], len(words)) for logs in self.logs], axis=1)
        fits = self.uses[:, scripts(words)].T
        fits |= ~fits.any(axis=1, keepdims=True)  # a script nobody uses excludes nobody
        return np.where(fits, found - found.max(axis=1, keepdims=True, where=fits, initial=-1e9), -1e4).astype(np.float32)

    def words_of(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the rows of ``scores`` that its words have."""
        if len(self.places) > _REMEMBERED:
            self._ready()
        split = [_WORD.findall(t.lower()) for t in texts]
        new = list({w for words in split for w in words if w not in self.places})
        if new:
            start = len(self.scores)
            parts = [self.word_scores(new[i : i + _NEW_WORDS]) for i in range(0, len(new), _NEW_WORDS)]
            self.scores = np.concatenate([self.scores, *parts])
            self.places.update(zip(new, range(start, start + len(new))))
        return [np.fromiter(map(self.places.__getitem__, words), np.int64, len(words)) for words in split]

    def labels(self, texts: list[str]) -> list[np.ndarray]:
        """The language of each word of each text; the texts are searched side by side, long ones first."""
        rows = self.words_of(texts)
        order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rows)
        at = 0
        while at < len(order) and len(rows[order[at]]):
            longest = len(rows[order[at]])
            many = max(1, _TRELLIS // (longest * len(self.langs)))
            block = [i for i in order[at : at + min(many, 512)] if len(rows[i])]
            for i, labels in zip(block, self._search([rows[i] for i in block])):
                found[i] = labels
            at += len(block)
        return found

    def _search(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """``rows`` descend in length, so the active ones are always the first."""
        sizes = np.array([len(r) for r in rows])
        steps, n_langs = int(sizes[0]), len(self.langs)
        words = np.zeros((steps, len(rows)), np.int64)
        for i, r in enumerate(rows):
            words[: len(r), i] = r
        active = len(rows) - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
        changed = np.zeros((steps, len(rows), n_langs), bool)
        best_before = np.zeros((steps, len(rows)), np.int16)
        value = self.scores[words[0]]
        last = np.zeros(len(rows), np.int64)
        for t in range(1, steps):
            n = active[t]
            if n < len(value):
                last[n : len(value)] = value[n:].argmax(axis=1)
                value = value[:n]
            best = value.argmax(axis=1)
            best_before[t, :n] = best
            jump = value[np.arange(n), best][:, None] - self.switch
            changed[t, :n] = jump > value
            value = np.maximum(value, jump) + self.scores[words[t, :n]]
        last[: len(value)] = value.argmax(axis=1)
        labels = np.zeros((steps, len(rows)), np.int16)
        current = last
        for t in range(steps - 1, -1, -1):
            n = active[t]
            labels[t, :n] = current[:n]
            moved = changed[t, np.arange(n), current[:n]]
            current[:n] = np.where(moved, best_before[t, :n], current[:n])
        return [labels[: len(r), i] for i, r in enumerate(rows)]

    def spans(self, text: str, labels: np.ndarray) -> list[dict]:
        """Stretches of one language: from the first letter of the first word to the last of the last."""
        if not len(labels):
            return []
        matches = list(_WORD.finditer(text.lower())) if len(text.lower()) == len(text) else list(_WORD.finditer(text))
        ends = np.append(np.flatnonzero(labels[1:] != labels[:-1]) + 1, len(labels))
        found, start = [], 0
        for end in ends.tolist():
            first, last = min(start, len(matches) - 1), min(end, len(matches)) - 1
            found.append({"lang": self.langs[labels[start]], "start": matches[first].start(), "stop": matches[last].end()})
            start = end
        return found


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the column ``lang`` from (doc_id, text, lang); rows without text or language teach nothing."""
    usable = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counted = sampled(usable, sample).mapInArrow(_counts, "lang string, slot bigint, n bigint")
    # at most languages x buckets rows
    rows = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, np.ndarray] = {}
    slots, times = rows.column("slot").to_numpy(), rows.column("n").to_numpy()
    names = np.array(rows.column("lang").to_pylist(), object)
    for lang in set(names):
        own = names == lang
        counts[lang] = np.zeros(BUCKETS + len(_NAMES))
        counts[lang][slots[own]] = times[own]
    return Model(counts)


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > _CHARS:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def _predicted(shared, with_spans: bool):
    def predict(texts: pa.Array) -> pa.Array:
        model = shared.value
        plain = [t or "" for t in texts.to_pylist()]
        langs, scores, spans = [], [], []
        for part in _blocks(plain):
            found = model.labels(part) if model.langs else [np.zeros(0, np.int16)] * len(part)
            for text, labels in zip(part, found):
                if len(labels):
                    letters = np.array([len(w) for w in _WORD.findall(text.lower())], float)
                    weight = np.bincount(labels, letters, len(model.langs))
                    langs.append(model.langs[int(weight.argmax())])
                    scores.append(float(weight.max() / weight.sum()))
                else:
                    langs.append(NONE)
                    scores.append(0.0)
                if with_spans:
                    spans.append(model.spans(text, labels))
        columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        names = ["lang", "score"]
        if with_spans:
            kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
            columns.append(pa.array(spans, kind))
            names.append("spans")
        return pa.StructArray.from_arrays(columns, names=names)

    spans = ", spans array<struct<lang:string,start:bigint,stop:bigint>>" if with_spans else ""
    return F.arrow_udf(predict, f"lang string, score double{spans}")


def predict(docs: DataFrame, model: Model, with_spans: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score and, if wanted, spans (in code points); columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = docs.withColumn("_p", _predicted(shared, with_spans)(whole(F.col("text"))))
    found = found.withColumn("lang_pred", F.col("_p.lang")).withColumn("score", F.col("_p.score"))
    if with_spans:
        found = found.withColumn("spans", F.col("_p.spans"))
    return found.drop("_p")


def held_out(divisor: int, remainder: int) -> Column:
    """Whether a document is only for testing, by the checksum of its id; one without an id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == remainder, F.lit(False))


@query
def op7_language_id(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out(4, 2)))
    tested = docs.select("doc_id", "text", held_out(4, 2).alias("held_out"))
    return predict(tested, model, with_spans=False).select("doc_id", "held_out", "lang_pred", "score")

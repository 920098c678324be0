"""Benchmark questions in documents, also with other numbers, names and units.

Text becomes a template: words in lower case without outer punctuation, a
number as <num>, a unit after a number as <unit>, a run of capitalised words
inside a sentence as <name>.  Every window of WINDOW template words is
hashed; of an item with fewer than three times as many words, every window of a third of them, of 3 words at least.  Windows of documents that occur in a benchmark item meet it in a hash
join; the windows of one document and item that lie on one diagonal (same
distance between the places) belong together.  What stands in the slots must be
consistent there: one name of the item always becomes the same name in
the document.  A number or unit may stand for two things, so windows that contradict what it mostly becomes
are left out, and the others count.  A window of nearly nothing but slots says little: with fewer than one plain word
in SPARSE it only counts where every slot has the item's own value, so a list of numbers is no match for another one.  Texts have several readings: PLAIN takes a capital at the start of a sentence for a word, NAMES for a
name; items are also read with their names as words, LOWER, for lower-cased copies.  The best reading counts.  A document contains an item when the words of consistent windows are at
least COVER of its words, and at least LEAST, or when RUN of them follow one another.  Windows shorter than WINDOW only count together
where their places in the document are near.  Items shorter than WINDOW are one window of their own length.

The windows of the benchmark are the stated query set.  They go to the tasks as sorted hashes,
in blocks of at most BLOCK; every block is one more pass over the documents, so memory is
bounded whatever the size of the benchmark.  Only hits are shuffled.

Null and empty texts have no windows, and items without words are never found.
Repeated rows are found alike.  Empty tables give an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.llm.common import doc_key, documents, query, small_join, sole
from tomeworks.sources.tables import read_table
from tomeworks.staging import stage

WINDOW = 8
COVER = 0.5
LEAST, RUN = 6, 13
SPARSE = 4
BLOCK = 1_000_000
PART = 1 << 18
_REMEMBERED_BYTES, _ENTRY_BYTES = 48 << 20, 150

# Fixed word lists.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "billion dozen half".split()
)
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms oz lb lbs "
    "pound pounds ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour "
    "hours day days week weeks month months year years usd eur dollar dollars cent cents euro euros percent % mph kmh "
    "degrees c f k w kw hz v".split()
)
_NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*[%€$£]?")
_STUCK = re.compile(rf"(?<=\d)(?=(?:{'|'.join(sorted((re.escape(u) for u in UNITS if u != '%'), key=len, reverse=True))})\b)")
_DIGIT_LETTER = re.compile(r"\d[A-Za-z]")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")

_TAIL = "\"')]}»”’*#$%&|<> "
_OUTER = "()[]{}<>\"'.,;:!?*#&|"

_WORD, _NUM, _UNIT, _CAPITAL, _NONE = range(5)
_SENTENCE_END = 8
PLAIN, NAMES, LOWER, LOWER_NAME = range(4)  # the last: a window of LOWER with a name in it
_STEP, _SIZED = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_HASHES = {kind: xxhash.xxh3_64_intdigest(name) for kind, name in ((_NUM, b"<num>"), (_UNIT, b"<unit>"), (_CAPITAL, b"<name>"))}


_SPECIAL = NUMBER_WORDS | UNITS


class _Words(dict):
    """Word as it stands -> its place in ``hashes``, ``kinds`` and ``values``; plain words have no value."""

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self) -> None:
        self.clear()
        _ARRAYS.clear()
        self.hashes, self.kinds, self.values = array("Q"), array("b"), []
        self.held = 0

    def places(self, words: list[str]) -> np.ndarray:
        """The place of each word.  This large dictionary is asked once for those that are alike."""
        distinct = dict.fromkeys(words)
        found = dict(zip(distinct, map(self.get, distinct)))
        fresh = [word for word, place in found.items() if place is None]
        self.learn(fresh)
        found.update(zip(fresh, map(self.__getitem__, fresh)))
        return np.fromiter(map(found.__getitem__, words), np.int64, len(words))

    def learn(self, words: list[str]) -> None:
        """Takes in words that differ and are not here; the plain ones, which most are, in one go."""
        plain, hashes, kinds, held = [], [], [], 0
        digest, special = xxhash.xxh3_64_intdigest, _SPECIAL
        for word in words:
            core = word if word.isalpha() else word.strip(_OUTER)
            if not (core.isalpha() and core.islower()) or (lower := core.lower()) in special:
                self[word]
                continue
            ends = core is not word and word.rstrip(_TAIL).endswith((".", "!", "?", ":"))
            plain.append(word)
            hashes.append(digest(lower.encode()))
            kinds.append(_WORD | _SENTENCE_END if ends else _WORD)
            held += len(word)
        self.update(zip(plain, range(len(self.kinds), len(self.kinds) + len(plain))))
        self.hashes.extend(hashes)
        self.kinds.extend(kinds)
        self.values.extend([None] * len(plain))
        self.held += held + _ENTRY_BYTES * len(plain)

    def __missing__(self, word: str) -> int:
        core = word.strip(_OUTER)
        number = None
        if not core.isalpha():  # most words are, and need no pattern
            number = _NUMBER.fullmatch(core)
            core = number[0].rstrip(".,:/") if number else _EDGES.sub("", word)
        lower = core.lower()
        if not core:
            kind = _NONE
        elif number or lower in NUMBER_WORDS:
            kind = _NUM
        elif lower in UNITS:
            kind = _UNIT
        else:
            kind = _CAPITAL if len(core) > 1 and core[0].isupper() and core[1:].islower() else _WORD
        last = word if word.isalpha() else word.rstrip(_TAIL)
        ends = _SENTENCE_END if last.endswith((".", "!", "?", ":")) else 0
        place = self[word] = len(self.kinds)
        self.hashes.append(xxhash.xxh3_64_intdigest(lower.encode()))
        self.kinds.append(kind | ends)
        slot = kind not in (_WORD, _NONE)
        self.values.append(lower if slot else None)
        self.held += _ENTRY_BYTES + len(word) + (len(lower) + 60 if slot else 0)
        return place


_ARRAYS: dict = {}
_SEEN = _Words()


def template(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and kinds of the template words in their plain reading, and their places in ``_SEEN``."""
    return next(readings(text, (PLAIN,)))[1:]


def readings(text: str, wanted: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(reading, hashes, kinds, places) of the readings, those after the first only where they differ from PLAIN."""
    for reading, hashes, kinds, places, _ in readings_of([text], wanted):
        yield reading, hashes, kinds, places


def readings_of(texts: list[str], wanted: tuple[int, ...]) -> Iterator[tuple[int, *(np.ndarray,) * 4]]:
    """(reading, hashes, kinds, places, text number) of the words of all texts, one text after the other."""
    sole(_SEEN)
    if _SEEN.held >= _REMEMBERED_BYTES:
        _SEEN.forget()
    words: list[str] = []
    sizes = []
    for text in texts:
        own = (_STUCK.sub(" ", text) if _DIGIT_LETTER.search(text) else text).split()
        words += own
        sizes.append(len(own))
    places = _SEEN.places(words)
    number = np.repeat(np.arange(len(texts)), sizes)
    known = _tables()
    marks = known[1][places]
    kinds = marks & 7
    # a capital after the end of a sentence is no name
    start = _before(marks & _SENTENCE_END, number, _SENTENCE_END) > 0
    real = kinds != _NONE
    if not real.all():
        places, kinds, start, number = places[real], kinds[real], start[real], number[real]
    kinds[(kinds == _UNIT) & (_before(kinds, number, _NONE) != _NUM)] = _WORD
    capital = kinds == _CAPITAL
    at_start = capital & start
    for reading in wanted:
        no_names = {PLAIN: at_start, NAMES: False, LOWER: capital}[reading]
        own = kinds, places, number
        if reading != PLAIN:
            other = np.zeros(len(texts), bool)
            other[number[at_start if reading == NAMES else capital]] = True
            if not other.any():
                continue
            own = tuple(x[other[number]] for x in own)
            no_names = no_names if reading == NAMES else no_names[other[number]]
        yield reading, *_filled(np.where(no_names, np.int8(_WORD), own[0]), *own[1:], known[0])


def _before(values: np.ndarray, number: np.ndarray, first: int) -> np.ndarray:
    """What stands before each word, ``first`` before the first one of a text."""
    before = np.empty_like(values)
    before[:1] = first
    before[1:] = np.where(number[1:] == number[:-1], values[:-1], values.dtype.type(first))
    return before


def _filled(kinds: np.ndarray, places: np.ndarray, number: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    # a name of several words is one slot, with the value of its first word
    first = ~((kinds == _CAPITAL) & (_before(kinds, number, _NONE) == _CAPITAL))
    if not first.all():
        places, kinds, number = places[first], kinds[first], number[first]
    hashes = known[places]
    for kind, h in _HASHES.items():
        hashes[kinds == kind] = h
    return hashes, kinds, places, number


def _marked(hashes: np.ndarray, reading: int) -> np.ndarray:
    """Window hashes of NAMES only meet their like."""
    return hashes ^ np.uint64(_STEP) if reading == NAMES else hashes


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The lists of ``_SEEN`` as arrays, extended when it has grown."""
    n = len(_SEEN.kinds)
    if not _ARRAYS:
        _ARRAYS.update(n=0, hashes=np.zeros(1024, np.uint64), kinds=np.zeros(1024, np.int8))
    if _ARRAYS["n"] < n:
        for name, source in (("hashes", _SEEN.hashes), ("kinds", _SEEN.kinds)):
            held = _ARRAYS[name]
            if len(held) < n:
                held = np.concatenate([held, np.zeros(max(n, 2 * len(held)) - len(held), held.dtype)])
            held[_ARRAYS["n"] : n] = source[_ARRAYS["n"] : n]
            _ARRAYS[name] = held
        _ARRAYS["n"] = n
    return _ARRAYS["hashes"], _ARRAYS["kinds"]


def window_size(n_words: int) -> int:
    """How many words of an item of this many words make a window."""
    return n_words if n_words < WINDOW else min(WINDOW, max(3, n_words // 3))


def window_hashes(hashes: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, hashes) of the windows of all these sizes, in ascending order."""
    total = np.zeros(len(hashes), np.uint64)
    for i in range(max(sizes, default=0)):
        n = len(hashes) - i
        if n <= 0:
            return
        total = total[:n] * np.uint64(_STEP) + hashes[i:]
        if i + 1 in sizes:
            own = total + np.uint64(i + 1) * np.uint64(_SIZED)
            yield i + 1, own ^ (own >> np.uint64(29))


def _slots(kinds: np.ndarray, places: np.ndarray, at: int, size: int) -> list[str]:
    own = np.flatnonzero(kinds[at : at + size] != _WORD) + at
    return [_SEEN.values[p] for p in places[own]]


_ITEMS = "item_id bigint, item_pos int, reading int, size int, n_words int, hash bigint, item_slots array<string>"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item, text in zip(batch.column("item_id"), batch.column("text")):
            for reading, hashes, kinds, places in readings(text.as_py() or "", (PLAIN, NAMES, LOWER)):
                capital = np.array([_SEEN.kinds[p] & 7 == _CAPITAL for p in places], bool)
                for size, found in window_hashes(hashes, [window_size(len(hashes))]):
                    for i, h in enumerate(_marked(found, reading).view(np.int64).tolist()):
                        own = LOWER_NAME if reading == LOWER and capital[i : i + size].any() else reading
                        rows.append((item.as_py(), i, own, size, len(hashes), h, _slots(kinds, places, i, size)))
        types = [pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.list_(pa.string())]
        columns = zip(*rows) if rows else [[]] * 7
        names = ["item_id", "item_pos", "reading", "size", "n_words", "hash", "item_slots"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


_HITS = "key binary, doc_id bigint, doc_pos int, hash bigint, doc_slots array<string>"


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of some PART bytes of ``column``: what is made of a piece is all that is held."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes, dtype=np.int64) // PART
    starts = np.flatnonzero(np.diff(piece, prepend=-1))
    for at, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield batch.slice(at, end - at)


def _hits(shared, sizes: list[int]) -> Callable:
    """Finds the windows of documents that are among the shared, sorted hashes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        low = np.zeros(1 << 22, bool)  # by the low bits first: few windows pass
        mask = np.uint64(len(low) - 1)
        low[wanted & mask] = True
        for batch in batches:
            for part in _parts(batch, "text"):
                rows = []
                texts = [text or "" for text in part.column("text").to_pylist()]
                for reading, hashes, kinds, places, number in readings_of(texts, (PLAIN, NAMES)):
                    first = np.searchsorted(number, np.arange(len(texts)))
                    for size, own in window_hashes(hashes, sizes):
                        own = _marked(own, reading)
                        maybe = np.flatnonzero(low[own & mask])
                        maybe = maybe[number[maybe] == number[maybe + size - 1]]  # not across texts
                        at = np.minimum(np.searchsorted(wanted, own[maybe]), len(wanted) - 1)
                        for i in maybe[wanted[at] == own[maybe]].tolist():
                            row = int(number[i])
                            rows.append((row, i - int(first[row]), int(own[i].astype(np.int64)), _slots(kinds, places, i, size)))
                if rows:
                    row, doc_pos, h, slots = zip(*rows)
                    whose = pa.array(row, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("key").take(whose),
                            part.column("doc_id").take(whose),
                            pa.array(doc_pos, pa.int32()),
                            pa.array(h, pa.int64()),
                            pa.array(slots, pa.list_(pa.string())),
                        ],
                        names=["key", "doc_id", "doc_pos", "hash", "doc_slots"],
                    )

    return find


def _is_name(value: str) -> bool:
    return value not in NUMBER_WORDS and value not in UNITS and not any(map(str.isdigit, value))


def _agreeing(hits: list[dict]) -> tuple[set[int], bool]:
    """Places in the item of the windows of one diagonal whose slots agree; whether slots have changed.

    None if a name becomes two; of numbers and units, what they become most often holds, and their own value before others.
    """
    times = Counter(pair for hit in hits for pair in zip(hit["item_slots"], hit["doc_slots"]))
    chosen: dict[str, str] = {}
    for i, d in sorted(times, key=lambda pair: (-times[pair], pair[0] != pair[1], pair)):
        if chosen.setdefault(i, d) != d and _is_name(i):
            return set(), False
    kept = [hit for hit in hits if all(chosen[i] == d for i, d in zip(hit["item_slots"], hit["doc_slots"]))]
    used = {i for hit in kept for i in hit["item_slots"]}
    return {hit["item_pos"] for hit in kept}, len(kept) < len(hits) or any(i != chosen[i] for i in used)


def _longest(words: set[int]) -> int:
    most = run = 0
    for i in sorted(words):
        run = run + 1 if i - 1 in words else 1
        most = max(most, run)
    return most


def covered(hits: list[dict], cover: float) -> tuple[int, float, bool] | None:
    """(windows, share of the item's words, changed) if the hits of a reading make the item; the best of the readings."""
    by_reading: dict[int, list[dict]] = {}
    for hit in hits:
        by_reading.setdefault(min(hit["reading"], LOWER), []).append(hit)
    # without a name in lower case, LOWER would only leave the names out
    if all(hit["reading"] == LOWER for hit in by_reading.get(LOWER, ())):
        by_reading.pop(LOWER, None)
    found = [got for own in by_reading.values() if (got := _covered(own, own[0]["size"], own[0]["n_words"], cover))]
    return max(found, key=lambda got: (got[1], not got[2], got[0]), default=None)


def _covered(hits: list[dict], size: int, n_words: int, cover: float) -> tuple[int, float, bool] | None:
    by_diagonal: dict[int, list[dict]] = {}
    for hit in hits:
        by_diagonal.setdefault(hit["doc_pos"] - hit["item_pos"], []).append(hit)
    held = []
    for diagonal in sorted(by_diagonal):
        at, changed = _agreeing(by_diagonal[diagonal])
        if at:
            held.append((diagonal, at, {i + k for i in at for k in range(size)}, changed))
    best, first = (0, 0, 0), 0
    whole = size >= min(WINDOW, n_words)
    times: Counter = Counter()  # how many diagonals in reach hold a word
    for last, (diagonal, _, words, _) in enumerate(held):
        times.update(words)
        while not whole and held[first][0] < diagonal - n_words // 2:
            times.subtract(held[first][2])
            times = +times
            first += 1
        if len(times) > best[0]:
            best = (len(times), first, last + 1)
    n, first, last = best
    run = max((_longest(words) for _, _, words, _ in held), default=0)
    if not n or (n < max(cover * n_words, min(n_words, LEAST)) and run < RUN):
        return None
    own = held[first:last]
    return len(set().union(*(at for _, at, _, _ in own))), n / n_words, any(changed for *_, changed in own)


_FOUND = "key binary, doc_id bigint, item_id bigint, n_windows bigint, coverage double, reparameterised boolean"


def _found(cover: float) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _SEEN.forget()  # the words have served the stage before
        for batch in batches:
            rows = []
            for key, doc_id, item_id, hits in zip(*batch.columns):  # one group at a time as Python objects
                if got := covered(hits.as_py(), cover):
                    rows.append((key.as_py(), doc_id.as_py(), item_id.as_py(), *got))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
            columns = zip(*rows) if rows else [[]] * 6
            names = ["key", "doc_id", "item_id", "n_windows", "coverage", "reparameterised"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return find


def contained_items(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """(key, doc_id, item_id, n_windows, coverage, reparameterised): which documents hold which items.

    ``key`` is ``common.doc_key()``; each document and item once.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    items = stage(rows.mapInArrow(_item_windows, _ITEMS), "item-windows")
    n, sizes = items.count(), sorted(r[0] for r in items.select("size").distinct().collect())
    keyed = docs.select(doc_key().alias("key"), F.col("doc_id").cast("bigint"), "text")
    hits = spark.createDataFrame([], _HITS)
    blocks = -(-n // BLOCK)
    for block in range(blocks):
        own = items.where(F.pmod("hash", F.lit(blocks)) == block).select("hash").distinct()
        wanted = np.sort(np.array([r[0] for r in own.toLocalIterator()], np.int64).view(np.uint64))
        if len(wanted):
            hits = hits.unionByName(keyed.mapInArrow(_hits(spark.sparkContext.broadcast(wanted), sizes), _HITS))
    hits = stage(hits, "window-hits")
    telling = (F.col("size") - F.size("item_slots")) * SPARSE >= F.col("size")
    met = small_join(hits, items, n, ["hash"], "inner").where(telling | (F.col("item_slots") == F.col("doc_slots")))
    hit = F.struct("reading", "size", "n_words", "item_pos", "doc_pos", "item_slots", "doc_slots")
    groups = met.groupBy("key", "doc_id", "item_id").agg(F.collect_set(hit))
    return groups.mapInArrow(_found(cover), _FOUND)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    found = stage(contained_items(docs, benchmark).select(F.col("key").alias("_k")).distinct(), "contaminated")
    keyed = docs.withColumn("_key", doc_key())
    return small_join(keyed, found, found.count(), F.col("_key") == F.col("_k"), "left_anti").select(*docs.columns)


def benchmark_table(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "benchmark")


@query
def op6_decontaminate(spark, folder):
    """The documents that hold an item of the benchmark, and which."""
    found = contained_items(documents(spark, folder).select("doc_id", "text"), benchmark_table(spark, folder))
    return found.select("doc_id", "item_id", "n_windows", "coverage", "reparameterised")

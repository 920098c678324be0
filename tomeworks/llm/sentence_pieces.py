"""SentencePiece BPE: text to piece ids and back, by a public model file.

A text is marked as the model asks: one marker in front, one for every space.
No piece of such a model has a marker after another character, so no merge
crosses from a word into the markers that follow, and a text is encoded word by
word (markers and what follows them).

The distinct-chunk table: marked words are counted over all documents, each of
those that recur is segmented once, and the ids are joined back by position.
The table goes to every task and is therefore bounded in bytes: it takes the
most frequent words that fit.  Words beyond it are segmented once per batch of
documents, in the task that holds them; sending those, and the ids of all
documents, through another join would write more than twice the input.
Nothing is lost by the bound, and the texts are never shuffled.

Many words are merged side by side: in every step each word merges its best
pair, the leftmost of equals.  Long ones use a heap over linked symbols.

Null text counts as empty; an empty text has the end id only.  Texts and words
may have any length, repeated rows are encoded alike, an empty table gives an
empty result, and columns of the names that are added are replaced.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from tomeworks.llm.common import documents, query, whole
from tomeworks.staging import stage

MODEL = "piece_bpe_32k.model"
MARK = "▁"
TABLE_BYTES = 64 * 1024 * 1024
_ENTRY_BYTES = 224  # of a word in a Python dictionary, besides its characters and ids
_COUNTED = 300_000  # words a task counts before it passes them on
_LONGEST = 64  # characters of a word merged side by side with others
_GATHERED = 2_000_000  # characters of the documents whose words beyond the table are gathered
_CODE_POINTS = 0x110000
_NO_PAIR = 1 << 30
_PROBE = " a  e\u0301\u00e9 \ufb01\u3000\uff21\tb "

_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def words_of(text: str) -> list[str]:
    """The marked words of a text, each without its first marker."""
    if "  " in text or MARK in text or text[:1] in ("", " "):
        return [word[1:] for word in _WORD.findall(marked(text))]
    return text.split(" ")


class Segmenter:
    """The pieces of one marked word, by the merges of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        plain = [
            i
            for i in range(self.size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        if any(MARK in pieces[i].lstrip(MARK) for i in plain):
            raise ValueError(f"{path} has pieces that cross a marker")
        if model.normalize(_PROBE) != marked(_PROBE):
            raise ValueError(f"{path} normalises its texts, or does not mark them in front")
        self.end = model.eos_id()
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.surface = [b""] * self.size
        for i in plain:
            self.surface[i] = pieces[i].replace(MARK, " ").encode()
        for b, i in enumerate(self.bytes):
            self.surface[i] = bytes([b])

        code = {pieces[i]: i for i in plain}
        symbol = lambda s: code.get(s, self.size + ord(s) if len(s) == 1 else None)
        self.first = np.arange(_CODE_POINTS, dtype=np.int32) + self.size
        for piece, i in code.items():
            if len(piece) == 1:
                self.first[ord(piece)] = i
        # the better the score, the lower the rank; equal scores are equally good
        scores = np.array([model.get_score(i) for i in range(self.size)])
        rank = np.unique(-scores, return_inverse=True)[1]
        pairs = {}
        for piece, i in code.items():
            for at in range(1, len(piece)):
                left, right = symbol(piece[:at]), symbol(piece[at:])
                if left is not None and right is not None:
                    pairs[self._key(left, right)] = (int(rank[i]), i)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)

    def _key(self, left, right):
        return left * (self.size + _CODE_POINTS) + right

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; _NO_PAIR where they do not merge."""
        wanted = self._key(left, right)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NO_PAIR), self.merged[at]

    def _symbols(self, text: str) -> np.ndarray:
        return self.first[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].astype(np.int64)

    def _side_by_side(self, words: list[str]) -> list[bytes]:
        symbols = self._symbols("".join(words))
        lengths = np.array([len(w) for w in words])
        starts = np.cumsum(lengths) - lengths
        ranks, into = np.full(len(symbols), _NO_PAIR), np.zeros(len(symbols), np.int64)
        inner = np.ones(len(symbols), bool)  # has a right neighbour in its word
        inner[starts + lengths - 1] = False
        at = np.flatnonzero(inner)
        ranks[at], into[at] = self._pairs(symbols[at], symbols[at + 1])
        while True:
            best = np.minimum.reduceat((ranks << 32) + np.arange(len(ranks)), starts)
            busy = best >> 32 < _NO_PAIR
            if not busy.any():
                break
            at = best[busy] & 0xFFFFFFFF
            symbols[at] = into[at]
            inner[at] = inner[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, ranks, into, inner = symbols[keep], ranks[keep], into[keep], inner[keep]
            lengths[busy] -= 1
            starts = np.cumsum(lengths) - lengths
            at -= np.arange(len(at))  # every word before has lost one symbol
            ranks[at] = _NO_PAIR
            before = at[at > starts[busy]] - 1
            changed = np.concatenate([at[inner[at]], before])
            ranks[changed], into[changed] = self._pairs(symbols[changed], symbols[changed + 1])
        packed = symbols.astype(np.int32).tobytes()
        found = [packed[s:e] for s, e in zip((4 * starts).tolist(), (4 * (starts + lengths)).tolist())]
        for i in np.flatnonzero(np.maximum.reduceat(symbols, starts) >= self.size).tolist():
            found[i] = self._ids(symbols[starts[i] : starts[i] + lengths[i]].tolist())
        return found

    def _alone(self, word: str) -> bytes:
        symbols = self._symbols(word).tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        found_ranks, found = self._pairs(np.array(symbols[:-1]), np.array(symbols[1:]))
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def pair(left: int, right: int) -> tuple[int, int]:
            if (left, right) not in known:
                rank, into = self._pairs(np.array([left]), np.array([right]))
                known[left, right] = int(rank[0]), int(into[0])
            return known[left, right]

        # (rank, place, the two symbols, what they become); outdated when a symbol has changed
        heap = [
            (r, i, symbols[i], symbols[i + 1], m)
            for i, (r, m) in enumerate(zip(found_ranks.tolist(), found.tolist()))
            if r < _NO_PAIR
        ]
        heapq.heapify(heap)

        def offer(left: int) -> None:
            right = after[left]
            if left >= 0 and right < n:
                rank, into = pair(symbols[left], symbols[right])
                if rank < _NO_PAIR:
                    heapq.heappush(heap, (rank, left, symbols[left], symbols[right], into))

        while heap:
            _, left, a, b, into = heapq.heappop(heap)
            right = after[left]
            if symbols[left] != a or right >= n or symbols[right] != b:
                continue
            symbols[left], symbols[right] = into, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return self._ids([s for s in symbols if s >= 0])

    def _ids(self, symbols: list[int]) -> bytes:
        ids: list[int] = []
        for s in symbols:
            if s < self.size:
                ids.append(s)
            else:
                ids.extend(self.bytes[b] for b in chr(s - self.size).encode())
        return np.array(ids, dtype=np.int32).tobytes()

    def segment(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word with the marker in front, packed as 32-bit integers."""
        found = {w: self._alone(MARK + w) for w in words if len(w) > _LONGEST}
        # words of similar length finish together
        short = sorted((w for w in words if len(w) <= _LONGEST), key=len)
        for i in range(0, len(short), 20_000):
            part = short[i : i + 20_000]
            found.update(zip(part, self._side_by_side([MARK + w for w in part])))
        return found

    def decode(self, ids: list[int]) -> bytes:
        """The text of the ids in UTF-8; bytes that are none become U+FFFD, one each."""
        data = b"".join(map(self.surface.__getitem__, ids))
        if data[:1] == b" " and next(i for i in ids if self.surface[i]) != self.bytes[0x20]:
            data = data[1:]  # of the marker in front
        try:
            data.decode()
        except UnicodeDecodeError:
            data = data.decode(errors="one-for-each-byte").encode()
        return data


codecs.register_error("one-for-each-byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))


def segmenter(spark: SparkSession, path: str | None = None):
    """A segmenter for tasks, of a size that depends on the model only (some 15 MB)."""
    return spark.sparkContext.broadcast(Segmenter(path or public_tokenizers.path(MODEL)))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): marked words that occur twice or more among those a task counts at a time, and how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def recurring() -> pa.RecordBatch:
            again = {w: n for w, n in counts.items() if n > 1}
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(again), pa.string()), pa.array(list(again.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                counts.update(words_of(text.as_py()))
                if len(counts) > _COUNTED:
                    yield recurring()
        yield recurring()

    seen = docs.select(whole(F.col("text"))).mapInArrow(count, "word string, n bigint")
    return seen.groupBy("word").agg(F.sum("n").alias("n"))


def chunk_table(docs: DataFrame, shared, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(word, ids): the most frequent marked words that fit into ``table_bytes``, each segmented once."""
    counts = stage(word_counts(docs), "words")
    octave = F.floor(F.log2("n") * 8)
    taken = F.octet_length("word") * 2 + _ENTRY_BYTES
    sizes = counts.groupBy(octave.alias("octave")).agg(F.sum(taken).alias("size"))
    least, left = None, table_bytes
    for row in sizes.orderBy(F.desc("octave")).collect():  # as many as a count has eighths of octaves
        left -= row["size"]
        if left < 0:
            break
        least = row["octave"]
    frequent = counts.where(octave >= least if least is not None else F.lit(False))

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.segment(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.binary())], ["word", "ids"]
            )

    return frequent.select("word").mapInArrow(segment, "word string, ids binary")


class _Table(dict):
    """Word -> packed ids; words that are not in it are noted and give none."""

    def __init__(self, entries):
        super().__init__(entries)
        self.late: set[str] = set()
        self.misses = 0

    def __missing__(self, word: str) -> bytes:
        self.late.add(word)
        self.misses += 1
        return b""


def _encode_some(texts: list[str], table: _Table, model: Segmenter, end: bytes) -> list[bytes]:
    packed, open_ones = [], []
    for text in texts:
        words = words_of(text)
        before = table.misses
        packed.append(b"".join(map(table.__getitem__, words)) + end)
        if table.misses > before:
            open_ones.append((len(packed) - 1, words))
    if open_ones:
        late = model.segment(list(table.late))
        table.late.clear()
        for i, words in open_ones:
            packed[i] = b"".join([table.get(w) or late[w] for w in words]) + end
    return packed


def _coded(
    docs: DataFrame, path: str | None, with_end: bool, table_bytes: int, keep: list[str], decoded: bool = False
) -> DataFrame:
    """The columns ``keep`` with ``ids``, and with ``decoded``, the text of the ids, if asked for."""
    spark = docs.sparkSession
    shared = segmenter(spark, path)
    rows = chunk_table(docs, shared, table_bytes).collect()  # at most table_bytes
    entries = spark.sparkContext.broadcast({r["word"]: bytes(r["ids"]) for r in rows})
    end = np.array([shared.value.end] if with_end else [], dtype=np.int32).tobytes()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = shared.value, _Table(entries.value)

        def coded(rows: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            packed = _encode_some(texts, table, model, end)
            offsets = np.cumsum([0] + [len(p) // 4 for p in packed])
            flat = np.frombuffer(b"".join(packed), dtype=np.int32)
            columns = [*rows.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))]
            if decoded:
                texts = [model.decode(memoryview(p).cast("i").tolist()) for p in packed]
                columns.append(pa.array(texts, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, [*keep, "ids", "decoded"][: len(columns)])

        for batch in batches:
            start, some, chars = 0, [], 0
            for at, text in enumerate(batch.columns[-1]):
                some.append(text.as_py())
                chars += len(some[-1])
                if chars > _GATHERED or at == len(batch) - 1:
                    yield coded(batch.slice(start, len(some)), some)
                    start, some, chars = at + 1, [], 0

    schema = docs.select(*keep).schema.add("ids", ArrayType(IntegerType()))
    if decoded:
        schema = schema.add("decoded", BinaryType())
    return docs.select(*keep, whole(F.col("text"))).mapInArrow(code, schema)


def encode(
    docs: DataFrame, path: str | None = None, with_end: bool = True, table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """``docs`` with ``ids`` array<int> and ``n_tokens``; they are read twice."""
    rest = docs.drop("ids", "n_tokens")
    coded = _coded(rest, path, with_end, table_bytes, rest.columns)
    return coded.withColumn("n_tokens", F.size("ids").cast("bigint"))


def token_text(shared, ids: Column) -> Column:
    """binary: the text of the ids in UTF-8; null ids as none."""

    @F.arrow_udf("binary")
    def decoded(lists: pa.Array) -> pa.Array:
        decode = shared.value.decode
        values = (x.values for x in lists)  # null for a null list
        return pa.array([decode(v.to_pylist()) if v is not None else b"" for v in values], pa.binary())

    return decoded(ids)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded`` binary, the text of its ``ids``."""
    return encoded.withColumn("decoded", token_text(segmenter(encoded.sparkSession, path), F.col("ids")))


@query
def op13_sentence_pieces(spark, folder):
    """Every document encoded and decoded again, as digests."""
    # both in one Python worker
    coded = _coded(documents(spark, folder), None, True, TABLE_BYTES, ["doc_id"], decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

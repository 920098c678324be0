"""Byte-level BPE: text to token ids and back, by the ranks of a public vocabulary.

Two tiers.  A minimal perfect hash over the vocabulary (one slot per entry, no
free slots) resolves every pre-token that is an entry as a whole.  Misses are
merged from bytes, always the pair of lowest rank, leftmost first: those of some
texts side by side in arrays, where each step merges one pair of every pre-token;
long ones by themselves, as a linked list with a heap of pairs.  Answers are remembered
per Python worker in a dictionary of bounded size.

Null text counts as empty and gives no ids.  Texts of any length are one row's
work; nothing is shuffled.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable
from itertools import chain, compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.llm.common import documents, query, sole, whole

VOCABULARY = "byte_bpe_50k.tiktoken"
_REMEMBERED = 400_000
_TOGETHER = 1 << 19  # characters of texts that are encoded in one go
_ROWS = 500  # of a batch that are Python strings at a time
_SHORT, _NO_PAIR = 64, 1 << 30  # bytes of pre-tokens merged side by side; the rank of what does not merge
_REMEMBERED_BYTES, _ENTRY_BYTES = 20 << 20, 150  # of each of the two generations

# Most texts only have these characters: ASCII without separators, and Latin letters.  For them a pattern of
# plain ranges, the same as public_tokenizers.PATTERN there, splits faster.
_PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7fÀ-ÖØ-öø-ž]*")
_L, _N = "A-Za-zÀ-ÖØ-öø-ž", "0-9"
_PLAIN_PATTERN = rf"""'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"""

# Odd 64-bit multipliers that spread the displacements.
_STEP, _MIX, _MASK = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file, in the order of their ranks."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    entries = {int(rank): base64.b64decode(entry) for entry, rank in pairs}
    if sorted(entries) != list(range(len(entries))):
        raise ValueError(f"the ranks in {path} are not 0 to {len(entries) - 1}")
    return [entries[rank] for rank in range(len(entries))]


class PerfectHash:
    """Slot of each of n keys in 0..n-1, by hashing into buckets and moving whole buckets.

    A bucket holds some two keys.  Larger buckets are placed first: each tries
    displacements until all its keys fall on free slots.  A bucket of one key
    simply takes a slot that is left, written as a negative displacement.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // 2)
        members: dict[int, list[int]] = {}
        spread = []
        for i, key in enumerate(keys):
            bucket, high = self._hashes(key)
            members.setdefault(bucket, []).append(i)
            spread.append(high)
        self.moves = [0] * self.buckets
        slots = [-1] * self.n
        single = []
        for bucket, group in sorted(members.items(), key=lambda item: (-len(item[1]), item[0])):
            if len(group) == 1:
                single.append((bucket, group[0]))
                continue
            move = 0
            while True:
                wanted = [self._slot(spread[i], move) for i in group]
                if all(slots[s] < 0 for s in wanted) and len(set(wanted)) == len(wanted):
                    break
                move += 1
            self.moves[bucket] = move
            for slot, i in zip(wanted, group):
                slots[slot] = i
        free = (s for s in range(self.n) if slots[s] < 0)
        for (bucket, i), slot in zip(single, free):
            self.moves[bucket] = -slot - 1
            slots[slot] = i
        self.slots = slots
        self.keys = [keys[i] for i in slots]
        self.arrays = np.array(self.moves, np.int64), np.array(slots, np.int64)

    def _hashes(self, key: bytes) -> tuple[int, int]:
        high, low = divmod(xxhash.xxh3_128_intdigest(key), 1 << 64)
        return low % self.buckets, high

    def _slot(self, high: int, move: int) -> int:
        mixed = (high ^ (move * _STEP)) * _MIX & _MASK
        return (mixed >> 24) % self.n

    def find(self, key: bytes) -> int:
        """The number of the key among those given, -1 when it is none of them."""
        bucket, high = self._hashes(key)
        move = self.moves[bucket]
        slot = -move - 1 if move < 0 else self._slot(high, move)
        return self.slots[slot] if self.keys[slot] == key else -1

    def find_all(self, keys: list[bytes]) -> list[int]:
        """find() of each of the keys."""
        if not self.n:
            return [-1] * len(keys)
        moves, slots = self.arrays
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").astype(np.uint64).reshape(-1, 2)
        move = moves[(hashes[:, 1] % np.uint64(self.buckets)).astype(np.int64)]
        mixed = (hashes[:, 0] ^ (move.astype(np.uint64) * np.uint64(_STEP))) * np.uint64(_MIX)
        slot = np.where(move < 0, -move - 1, ((mixed >> np.uint64(24)) % np.uint64(self.n)).astype(np.int64))
        found = zip(keys, map(self.keys.__getitem__, slot.tolist()), slots[slot].tolist())
        return [number if key == own else -1 for key, own, number in found]


class Memory(dict):
    """Pre-token -> its ids as packed 32-bit integers, in two generations.

    When the younger is full it becomes the older and the older is forgotten;
    what is asked for again moves back to the younger.
    """

    def __init__(self, find):
        super().__init__()
        self.find = find
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.older: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, pre_token: str) -> bytes:
        got = self.older.get(pre_token)
        if got is None:
            got = np.array(self.find(pre_token), dtype=np.int32).tobytes()
        self.keep(pre_token, got)
        return got

    def keep(self, pre_token: str, got: bytes) -> None:
        if len(pre_token) < 64:
            if len(self) >= _REMEMBERED or self.held >= _REMEMBERED_BYTES:
                older = dict(self)
                self.forget()
                self.older = older
            self.held += _ENTRY_BYTES + len(pre_token) + len(got)
            self[pre_token] = got

    def many(self, pre_tokens: Iterable[str], find_all) -> dict[str, bytes]:
        """The ids of pre-tokens that differ; those not remembered are found by one call of ``find_all``."""
        found = dict(zip(pre_tokens, map(self.get, pre_tokens)))
        absent = [t for t, got in found.items() if got is None]
        found.update(zip(absent, map(self.older.get, absent)))
        fresh = [t for t in absent if found[t] is None]
        found.update(zip(fresh, find_all(fresh)))
        for t in absent:
            self.keep(t, found[t])
        return found


class Encoder:
    def __init__(self, entries: list[bytes], pattern: str = public_tokenizers.PATTERN):
        self.entries = entries
        self.pattern = pattern
        self.hash = PerfectHash(entries)
        rank = {entry: rank for rank, entry in enumerate(entries)}
        halves = ((rank.get(e[:at]), rank.get(e[at:]), r) for e, r in rank.items() for at in range(1, len(e)))
        pairs = np.array([(a, b, r) for a, b, r in halves if a is not None and b is not None], np.int64).reshape(-1, 3)
        keys = pairs[:, 0] * len(entries) + pairs[:, 1]
        order = np.argsort(keys)
        self.pairs = np.append(keys[order], -1), np.append(pairs[order, 2], _NO_PAIR)  # one more, found by none
        self.bytes = np.array([rank.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.byte_pairs = np.full(1 << 16, _NO_PAIR)
        for entry, r in rank.items():
            if len(entry) == 2:
                self.byte_pairs[int.from_bytes(entry)] = r
        self._ready()

    def __getstate__(self):
        return {name: self.__dict__[name] for name in ("entries", "pattern", "hash", "pairs", "bytes", "byte_pairs")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _ready(self):
        self.split_any = regex.compile(self.pattern).findall
        self.split_plain = re.compile(_PLAIN_PATTERN).findall if self.pattern == public_tokenizers.PATTERN else None
        self.rank = {entry: rank for rank, entry in enumerate(self.entries)}
        self.known = Memory(self.piece)
        self.last: tuple[pa.Array, pa.Array] | None = None

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one pre-token that is no entry itself."""
        n = len(piece)
        after = list(range(1, n + 1))  # where the next part begins
        before = list(range(-1, n - 1))
        rank = self.rank
        heap = []
        for i in range(n - 1):
            if (r := rank.get(piece[i : i + 2])) is not None:
                heap.append((r, i, i + 1, i + 2))
        heapq.heapify(heap)
        while heap:
            _, left, middle, end = heapq.heappop(heap)
            if after[left] != middle or middle >= n or after[middle] != end:
                continue  # one of the two parts has changed since
            after[left] = end
            after[middle] = -1
            if end < n:
                before[end] = left
                if (r := rank.get(piece[left : after[end]])) is not None:
                    heapq.heappush(heap, (r, left, end, after[end]))
            if (previous := before[left]) >= 0:
                if (r := rank.get(piece[previous:end])) is not None:
                    heapq.heappush(heap, (r, previous, left, end))
        ids, at = [], 0
        while at < n:
            ids.append(rank[piece[at : after[at]]])
            at = after[at]
        return tuple(ids)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair of ids makes, which is its rank; _NO_PAIR where there is none."""
        keys, ranks = self.pairs
        wanted = left * len(self.entries) + right
        at = np.searchsorted(keys[:-1], wanted)
        return np.where(keys[at] == wanted, ranks[at], _NO_PAIR)

    def side_by_side(self, pieces: list[bytes]) -> list[bytes]:
        """merged() of each of these pre-tokens, packed as 32-bit integers."""
        if not pieces:
            return []
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.bytes[data]
        lengths = np.array(list(map(len, pieces)))
        starts = np.cumsum(lengths) - lengths
        inner = np.ones(len(ids), bool)  # has a right neighbour in its pre-token
        inner[starts + lengths - 1] = False
        ranks = np.full(len(ids), _NO_PAIR)
        at = np.flatnonzero(inner)
        ranks[at] = self.byte_pairs[data[at].astype(np.int64) << 8 | data[at + 1]]
        while True:
            best = np.minimum.reduceat((ranks << 32) + np.arange(len(ranks)), starts)
            busy = best >> 32 < _NO_PAIR
            if not busy.any():
                break
            at = best[busy] & 0xFFFFFFFF
            ids[at] = ranks[at]
            inner[at] = inner[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, ranks, inner = ids[keep], ranks[keep], inner[keep]
            lengths[busy] -= 1
            starts = np.cumsum(lengths) - lengths
            at -= np.arange(len(at))  # every pre-token before has lost one part
            ranks[at] = _NO_PAIR
            changed = np.concatenate([at[inner[at]], at[at > starts[busy]] - 1])
            ranks[changed] = self._ranks(ids[changed], ids[changed + 1])
        packed = ids.astype(np.int32).tobytes()
        return [packed[a:b] for a, b in zip((4 * starts).tolist(), (4 * (starts + lengths)).tolist())]

    def pieces(self, pre_tokens: list[str]) -> list[bytes]:
        """piece() of each, packed as 32-bit integers."""
        data = [t.encode() for t in pre_tokens]
        numbers = self.hash.find_all(data)
        longest = _SHORT if (self.bytes >= 0).all() else -1
        together = [len(d) <= longest and number < 0 for d, number in zip(data, numbers)]
        found = iter(self.side_by_side(list(compress(data, together))))
        return [
            next(found)
            if short
            else np.array([number] if number >= 0 else self.merged(d), np.int32).tobytes()
            for d, number, short in zip(data, numbers, together)
        ]

    def piece(self, pre_token: str) -> tuple[int, ...]:
        data = pre_token.encode()
        found = self.hash.find(data)
        return (found,) if found >= 0 else self.merged(data)

    def split(self, text: str) -> list[str]:
        plain = self.split_plain and _PLAIN.fullmatch(text)
        return self.split_plain(text) if plain else self.split_any(text)

    def encode(self, text: str) -> np.ndarray:
        sole(self.known)
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.split(text))), dtype=np.int32)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as 32-bit integers."""
        sole(self.known)
        found: list[bytes] = []
        ends = np.cumsum([len(text) for text in texts], dtype=np.int64) // _TOGETHER
        starts = np.flatnonzero(np.diff(ends, prepend=-1)).tolist()
        for at, end in zip(starts, [*starts[1:], len(texts)]):
            parts = list(map(self.split, texts[at:end]))
            known = self.known.many(dict.fromkeys(chain.from_iterable(parts)), self.pieces)
            found.extend(b"".join(map(known.__getitem__, part)) for part in parts)
        return found

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        """The ids of a column of texts.

        Spark asks once for the ids and once more for what is made of them, such as decode(), one after
        the other in the same worker; the second time the answer to the same column is given again.
        """
        last, self.last = self.last, None
        if last is not None and last[0].equals(texts):
            return last[1]
        found: list[bytes] = []
        for at in range(0, len(texts), _ROWS):
            found += self.encode_all([x or "" for x in texts.slice(at, _ROWS).to_pylist()])
        offsets = np.cumsum([0, *map(len, found)]) // 4
        flat = np.frombuffer(b"".join(found), np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        self.last = texts, ids
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids.tolist()))


def encoder(spark: SparkSession, path: str | None = None):
    """An encoder for tasks: read and hashed once here, sent once to each executor (a few MB)."""
    return spark.sparkContext.broadcast(Encoder(read_ranks(path or public_tokenizers.path(VOCABULARY))))


def token_ids(shared, text: Column) -> Column:
    """array<int>: the ids of the text."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return shared.value.encode_batch(texts)

    return ids(whole(text))


def token_bytes(shared, ids: Column) -> Column:
    """binary: the bytes that the ids stand for; null ids as none."""

    @F.arrow_udf("binary")
    def decoded(lists: pa.Array) -> pa.Array:
        decode = shared.value.decode
        values = (x.values for x in lists)  # null for a null list
        return pa.array([decode(v.to_numpy()) if v is not None else b"" for v in values], pa.binary())

    return decoded(ids)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` array<int> and ``n_tokens`` (columns of these names are replaced)."""
    rest = docs.drop("ids", "n_tokens")
    ids = rest.withColumn("ids", token_ids(encoder(docs.sparkSession, path), F.col("text")))
    return ids.withColumn("n_tokens", F.size("ids").cast("bigint"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded`` binary, the bytes of its ``ids``."""
    shared = encoder(encoded.sparkSession, path)
    return encoded.withColumn("decoded", token_bytes(shared, F.col("ids")))


@query
def op5_byte_bpe(spark, folder):
    """Every document encoded and decoded again, as digests."""
    encoded = encode(documents(spark, folder).select("doc_id", "text")).drop("text")
    return decode(encoded).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Near-duplicate documents by MinHash with one permutation.

Texts with the same words in the same order form a class and are handled once.
A class is described by its set of word shingles.  One hash per shingle is
enough for the whole signature: its top bits choose one of 128 bins, each bin
keeps its smallest hash, and an empty bin borrows from a filled one, chosen by a
hash of its own number and of the attempt (optimal densification).  Four bins
make a band, 32 bands a document; a band is a bucket key.  Two sets of
similarity 0.8 share at least one bucket with a chance of 1 - 5e-8.

Links are confirmed on the full sets.  Comparing all members of a bucket would
square its size, so a bucket is a star: its members are compared with the
member that has most bucket-mates.  What a star leaves unlinked may still be linked with
others, so the members outside the largest component of a bucket are compared
with all of its members but the centre, in blocks of bounded size.  No bucket is capped and no
member dropped.

Components are found on the links, and every document gets the smallest doc_id
of its component.  A null doc_id counts as larger than all others; in a component
without any id the component_id is null and all documents are kept.  Documents
without words have an empty set and are alone.  Repeated rows of one id are in
one component and all carry its id.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeworks.llm.common import doc_key, documents, query, small_join, sole
from tomeworks.llm.components import components
from tomeworks.staging import stage

BINS, BANDS = 128, 32
SHINGLE = 5
PERCENT = 80
BLOCK = 1_000_000  # shingles that one comparison holds on either side
_REMEMBERED_BYTES, _ENTRY_BYTES, _LONGEST = 24 << 20, 140, 64
_ATTEMPTS = 64

_rng = np.random.Generator(np.random.PCG64(20240229))
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
# Where an empty bin looks, attempt by attempt; the last resort is to try all bins in turn.
_LOOKS = np.concatenate(
    [_rng.integers(0, BINS, (_ATTEMPTS, BINS)), (np.arange(BINS)[None, :] + np.arange(BINS)[:, None]) % BINS]
)


class _WordHashes(dict):
    """Hashes of words, in a bounded number of bytes; long words are not remembered."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh3_64_intdigest(word)
        if len(word) <= _LONGEST:
            if self.held >= _REMEMBERED_BYTES:
                self.forget()
            self.held += len(word) + _ENTRY_BYTES
            self[word] = got
        return got

    def forget(self) -> None:
        self.clear()
        self.held = 0


_WORDS = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """bytes.lower() folds A-Z and bytes.split() cuts at the six blanks, nothing else."""
    return (text or "").encode(errors="replace").lower().split()


def shingles(split: list[bytes], size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; with fewer words the whole sequence is one."""
    if not split:
        return np.zeros(0, np.uint64)
    sole(_WORDS)
    h = np.fromiter(map(_WORDS.__getitem__, split), np.uint64, len(split))
    size = min(size, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total = _mixed(total * _C1 + h[i : len(h) - size + 1 + i])
    return np.unique(total)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin, empty bins filled from others."""
    bins = (hashes >> np.uint64(57)).astype(np.int64)  # ascending, as the hashes are
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    found = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    found[bins[first]] = hashes[first]
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    for look in _LOOKS:
        if not len(empty):
            break
        hit = filled[look[empty]]
        found[empty[hit]] = found[look[empty[hit]]]
        empty = empty[~hit]
    return found


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One bucket key per band; the band's number is part of it."""
    rows = signature(hashes).reshape(BANDS, BINS // BANDS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(rows.shape[1]):
        key = _mixed(key * _C1 + rows[:, i])
    return key.view(np.int64)


_SIGNED = "doc_id bigint, row_key binary, key binary, n_shingles bigint, bands array<bigint>"


def _signed(size: int) -> Callable:
    """The class, which is the digest of the words, and the signature of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts, bands = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                hashes = shingles(words, size)
                keys.append(hashlib.md5(b" ".join(words)).digest())
                counts.append(len(hashes))
                bands.append(band_keys(hashes) if len(hashes) else None)
            columns = [
                *(batch.column(c) for c in ("doc_id", "row_key")),
                pa.array(keys, pa.binary()),
                pa.array(counts, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "key", "n_shingles", "bands"])

    return make


def _sets(size: int) -> Callable[[Column], Column]:
    def make(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(words_of(t.as_py()), size).view(np.int64) for t in texts], pa.list_(pa.int64()))

    return F.arrow_udf(make, "array<bigint>")


def _linked(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _near_in_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _centres(members: DataFrame) -> DataFrame:
    """(bucket, c): the member of each bucket that has most bucket-mates, in all its buckets together."""
    mates = members.groupBy("key").agg(F.sum("n_members").alias("mates"))
    ranked = members.join(mates, "key")
    centre = F.max_by(F.struct("key", "n_shingles"), F.struct("mates", "key"))
    return ranked.groupBy("bucket").agg(centre.alias("c"))


def _star_pairs(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Every member with the centre of each of its buckets, once."""
    pairs = members.join(centres, "bucket").where(F.col("key") != F.col("c.key"))
    fitting = pairs.where(_near_in_size(F.col("n_shingles"), F.col("c.n_shingles"), percent))
    return fitting.select(F.col("key").alias("a"), F.col("c.key").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("key").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("key").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(_linked(shared, F.size("set_a"), F.size("set_b"), percent)).select("a", "b")


def _rest_blocks(members: DataFrame, centres: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (bucket, ublock, mblock, is_query, key, root) of the comparisons that the stars leave open.

    The centre has been compared with all others; of these, the queries are the
    ones outside their largest component.
    """
    members = members.join(centres, "bucket").where(F.col("key") != F.col("c.key"))
    rooted = members.join(roots, members["key"] == roots["node"], "left")
    rooted = rooted.select("bucket", "key", "n_shingles", F.coalesce("root", "key").alias("root"))
    parts = rooted.groupBy("bucket", "root").agg(F.sum("n_shingles").alias("n"))
    sizes = parts.groupBy("bucket").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.max("n").alias("most"),
        F.sum("n").alias("all"),
        F.count("*").alias("parts"),
    )
    open_ = sizes.where("parts > 1").select(
        "bucket",
        "main",
        F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("u_blocks"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("m_blocks"),
    )
    rows = rooted.join(open_, "bucket").withColumn("place", F.xxhash64("key"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod("place", n).cast("int")
    queries = rows.where("root != main").select(
        "bucket", "key", "root", own("u_blocks").alias("ublock"), every("m_blocks").alias("mblock"), F.lit(True).alias("is_query")
    )
    others = rows.select(
        "bucket", "key", "root", every("u_blocks").alias("ublock"), own("m_blocks").alias("mblock"), F.lit(False).alias("is_query")
    )
    return queries.unionByName(others)


def _compare(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links between the queries of a block and its members, one for each query and other component."""

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        queries, others = block[block.is_query], block[~block.is_query]
        found = []
        if len(queries) and len(others):
            keys, roots = others.key.to_list(), others.root.to_list()
            sizes = np.array([len(s) for s in others.set])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            vocabulary, flat = np.unique(np.concatenate(others.set.to_list()), return_inverse=True)
            for key, root, own in zip(queries.key, queries.root, queries.set):
                at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
                mark = np.zeros(len(vocabulary), np.int32)
                mark[at[vocabulary[at] == own]] = 1
                shared = np.add.reduceat(mark[flat], starts)
                met = np.flatnonzero(100 * shared >= percent * (len(own) + sizes - shared))
                found += {roots[i]: (key, keys[i]) for i in met if roots[i] != root}.values()
        return pd.DataFrame(found, columns=["a", "b"])

    return compare


def links(classes: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): confirmed links between classes that imply all others.

    ``classes``: stage table (key, n_shingles, bands, row_key); ``row_key`` names a row of the class in ``rows`` (row_key, text).
    Only the texts of classes that share a bucket are read again.
    """
    buckets = classes.where("n_shingles > 0").select("key", "n_shingles", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n_members")).where("n_members > 1")
    members = stage(buckets.join(shared, "bucket"), "members")
    wanted = stage(members.select("key").distinct().join(classes.select("key", "row_key"), "key"), "candidates")
    chosen = small_join(rows, wanted, wanted.count(), ["row_key"], "inner").dropDuplicates(["key"])
    sets = stage(chosen.select("key", _sets(size)(F.col("text")).alias("set")), "sets")
    centres = stage(_centres(members), "centres")
    stars = stage(_confirmed(_star_pairs(members, centres, percent), sets, percent), "star-links")
    blocks = stage(_rest_blocks(members, centres, stage(components(stars), "roots")), "blocks")
    rest = blocks.join(sets, "key").groupBy("bucket", "ublock", "mblock").applyInPandas(_compare(percent), "a binary, b binary")
    return stars.unionByName(rest)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(row_key, doc_id, n_shingles, component_id) of every row of ``docs``.

    ``row_key`` is ``common.doc_key()``; rows with the same one are in one component.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), doc_key().alias("row_key"), F.col("text").cast("string"))
    signed = stage(rows.mapInArrow(_signed(size), _SIGNED), "signatures")
    # the rows of a class agree in all but the id
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first")
    same = [F.first(c).alias(c) for c in ("n_shingles", "bands")]
    classes = stage(signed.groupBy("key").agg(*same, first, F.min("row_key").alias("row_key")), "classes")
    found = stage(links(classes, rows.select("row_key", "text"), size, percent), "links")
    roots = stage(components(found), "roots")
    rooted = classes.select("key", "first").join(roots, F.col("key") == F.col("node"), "left")
    rooted = rooted.select("key", F.coalesce("root", "key").alias("root"), "first")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("smallest"))
    named = rooted.join(smallest, "root").select("key", "smallest")
    alone = F.when(F.col("n_shingles") == 0, F.struct("doc_id", "row_key")).otherwise(F.struct("smallest.doc_id", "smallest.row_key"))
    return signed.join(named, "key").select(
        "row_key", "doc_id", "n_shingles", alone["doc_id"].alias("component_id"), alone["row_key"].alias("first_key")
    )


def stage_docs(docs: DataFrame) -> DataFrame:
    """For a pipeline: one document of each component stays, that of the smallest id and then the smallest key.

    Null ids come last.  Of rows that repeat it in id and text one stays.
    """
    found = near_duplicates(docs).where(F.col("row_key") == F.col("first_key"))
    kept = stage(found.groupBy("row_key").agg(F.count("*").alias("n")), "kept")
    return _one_each(docs, kept)


def _one_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    columns = docs.columns
    joined = docs.withColumn("_key", doc_key()).join(
        kept.select(F.col("row_key").alias("_k"), F.col("n").alias("_n")), F.col("_key") == F.col("_k")
    )
    single = joined.where("_n = 1").select(*columns)
    return single.unionByName(joined.where("_n > 1").dropDuplicates(["_key"]).select(*columns))


@query
def op8_near_dup(spark, folder):
    found = near_duplicates(documents(spark, folder).select("doc_id", "text"), size=2)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))

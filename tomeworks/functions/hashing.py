"""Hash buckets for terms."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 10_000


def md5_bucket(term: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """First 32 bits of the MD5 digest modulo ``buckets``; the same in any SQL engine."""
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def md5_buckets(terms: pa.Array, buckets: int = DEFAULT_BUCKETS) -> np.ndarray:
    """``md5_bucket`` of terms inside a task."""
    firsts = b"".join(hashlib.md5(t, usedforsecurity=False).digest()[:4] for t in terms.cast(pa.binary()).to_pylist())
    return (np.frombuffer(firsts, ">u4") % buckets).astype(np.int32)


def fast_bucket(term: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """xxHash64 modulo ``buckets``: cheaper, for runs nothing else has to reproduce."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


_LOW = (1 << 32) - 1
_FACTOR = 1_000_003  # a fixed value of the hash


def string_hash(term: Column) -> Column:
    """The 64-bit multiplicative hash that early versions of Python give a byte string, here of the UTF-8 bytes.

    From the first byte shifted by 7: for every byte, times 1,000,003 and xor the
    byte, modulo 2**64; at last xor the length.  -1 becomes -2, and nothing is 0.
    The product is made of two halves, as a long must not overflow.
    """
    # read as Latin-1, every byte is one character
    chars = F.split(F.decode(F.encode(term, "UTF-8"), "ISO-8859-1"), "")
    codes = F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))

    def step(h: Column, byte: Column) -> Column:
        low = h.bitwiseAND(F.lit(_LOW)) * F.lit(_FACTOR)
        high = F.shiftrightunsigned(h, 32) * F.lit(_FACTOR) + F.shiftrightunsigned(low, 32)
        product = F.shiftleft(high.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))
        return product.bitwiseXOR(byte)

    def end(h: Column) -> Column:
        full = h.bitwiseXOR(F.octet_length(term).cast("bigint"))
        return F.when(full == -1, F.lit(-2).cast("bigint")).otherwise(full)

    start = F.shiftleft(F.ascii(F.decode(F.encode(term, "UTF-8"), "ISO-8859-1")).cast("bigint"), 7)
    return F.aggregate(codes, start, step, end)


def string_bucket(term: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """``string_hash`` modulo ``buckets``: the buckets of vectors made by runs that used it."""
    return F.pmod(string_hash(term), F.lit(buckets)).cast("int")


BUCKET_FUNCTIONS = {"md5": md5_bucket, "xxhash64": fast_bucket, "string": string_bucket}

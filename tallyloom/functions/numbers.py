"""Repeatable hashing and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def hash_text(key: Column, seed: int) -> Column:
    """128-bit hash of a key as text, for orders that must look random."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_long(key: Column, seed: int) -> Column:
    """Non-negative 60-bit hash of a key."""
    return F.conv(F.substring(hash_text(key, seed), 1, 15), 16, 10).cast("long")


def hash_bucket(keys: list[Column], seed: int, buckets: int) -> Column:
    """Bucket number from keys of any type, null included.

    It depends on nothing but the keys and the seed, so repeated runs, retried
    tasks and other engines agree, and buckets of different seeds are independent.
    """
    joined = F.concat_ws(",", *[F.coalesce(key.cast("string"), F.lit("null")) for key in keys])
    return F.pmod(hash_long(joined, seed), F.lit(buckets)).cast("int")


def int_quotient(total: Column, count: Column) -> Column:
    """Integer quotient of non-negative integers, exact for any size; NULL for a zero count."""
    return F.call_function("div", total, F.nullif(count, F.lit(0)))

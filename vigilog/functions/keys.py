"""Columns computed from a row's key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: str, buckets: int = 100) -> Column:
    """A number below ``buckets`` that depends on the key alone: the first 32 bits of its MD5, modulo ``buckets``."""
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def long_hash(key: str) -> Column:
    """The first 60 bits of the key's MD5, as a whole number from 0; NULL hashes as the empty text."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")

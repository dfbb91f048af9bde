"""Salted key hashing.

A row's fate (train/test side, sample rank, synthetic value) is a pure
function of ``(salt, key)``: independent of partitioning, task retries and
the order rows arrive in, so it is stable as a table grows and under any
executor loss.  The digest is the first 32 bits of ``md5(salt ':' key)``,
which any SQL engine with ``md5`` can reproduce (the oracle does).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabflow.functions._util import as_col

HASH_RANGE = 1 << 32


def hash_int(key, salt) -> Column:
    """Unsigned 32-bit integer in ``[0, 2**32)`` from ``md5(salt:key)``."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), as_col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(key, salt, buckets: int = 10000) -> Column:
    """Bucket in ``[0, buckets)``."""
    return hash_int(key, salt) % F.lit(buckets)


def hash_unit(key, salt) -> Column:
    """Pseudo-uniform double in ``[0, 1)``."""
    return hash_int(key, salt) / F.lit(float(HASH_RANGE))

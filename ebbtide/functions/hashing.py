"""Reproducible pseudo-random numbers taken from a row's key.

They depend on the key and the seed alone, so repartitioning, retries and lost executors do not
change them.
"""

from pyspark.sql import Column, functions as F


def row_hash(key: Column, seed: int) -> Column:
    """32 hexadecimal digits; a null key hashes like an empty one."""
    return F.md5(F.concat(F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))))


def hash_bucket(digest: Column, digits: int) -> Column:
    """The first hexadecimal digits as a whole number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def unit_hash(key: Column, seed: int) -> Column:
    """A number in [0, 1)."""
    return hash_bucket(row_hash(key, seed), 8) / F.lit(float(2**32))

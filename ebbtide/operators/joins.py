"""Joins with mapping tables and with sets of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unique_lookup(mapping: DataFrame, key: str, value: str) -> DataFrame:
    """(``lookup_key``, ``lookup_value``) with one row per key.

    A table has no order, so "the last entry wins" has no meaning here: a key with two different
    values fails the query.
    """
    low, high = F.min(value), F.max(value)
    clash = F.raise_error(F.concat(F.lit(f"two values of {value} for "), F.col(key)))
    return (
        mapping.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("lookup_key"))
        .agg(F.when(low == high, low).when(low.isNotNull(), clash).alias("lookup_value"))
    )


def look_up(df: DataFrame, lookup: DataFrame, source: str, target: str) -> DataFrame:
    """Add ``target``: the value mapped to ``source``, null where there is none.

    No broadcast hint: a mapping is broadcast when its measured size allows it, and otherwise
    joined by a shuffle whose hot values are split at run time.
    """
    key = f"{target}__key"
    keyed = lookup.select(F.col("lookup_key").alias(key), F.col("lookup_value").alias(target))
    return df.join(keyed, F.col(source) == F.col(key), "left").drop(key)


def match_keys(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows whose ``key`` is (``left_semi``) or is not (``left_anti``) among distinct ``keys``.

    Spark broadcasts the keys if they are small. If not, both sides are shuffled, and adaptive execution
    splits the rows of a hot key.
    """
    return df.join(keys.select(key), key, how).select(*df.columns)

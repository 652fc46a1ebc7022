"""Reproducible sampling and splitting by key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import hash_bucket, row_hash, unit_hash
from ..schemas import CUSTOMER
from ..session import materialise
from .joins import match_keys


def smallest_by_hash(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The ``n`` rows whose key hashes lowest; ``key`` must be unique.

    Equal to ordering by (hash, key) and taking ``n``, but no task ever holds the whole result:
    rows are counted per hash bucket, the running count tells where each bucket's ranks begin, and
    only buckets that can contribute are ranked, each for itself. There are 65,536 buckets, so the
    counts are small whatever the size of the table.
    """
    hashed = df.withColumn("digest", row_hash(F.col(key), seed))
    hashed = hashed.withColumn("bucket", hash_bucket(F.col("digest"), 4))
    counts = hashed.groupBy("bucket").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("bucket")) - F.col("size")
    starts = counts.select("bucket", before.alias("before")).filter(F.col("before") < n)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("digest", key))
    return (
        hashed.join(F.broadcast(starts), "bucket")  # at most 65,536 narrow rows
        .withColumn("rank", rank)
        .filter(F.col("before") + F.col("rank") <= n)
        .select(*df.columns)
    )


def sample_customers(transactions: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` customers, always the same ones for one seed."""
    customers = materialise(transactions.select(CUSTOMER).distinct(), "customers")  # read twice
    return smallest_by_hash(customers, CUSTOMER, n, seed)


def restrict_to_sample(tables: Mapping[str, DataFrame], customers: DataFrame) -> dict[str, DataFrame]:
    """Keep the rows of the sampled customers in every table.

    The list grows with the sample size asked for, so the join method is left to its size.
    """
    return {name: match_keys(df, customers, CUSTOMER, "left_semi") for name, df in tables.items()}


def split_by_hash(
    df: DataFrame, test_size: float, seed: int, key: str = CUSTOMER
) -> tuple[DataFrame, DataFrame]:
    """Train and test set. A key is always on one side, whatever the partitioning."""
    in_test = unit_hash(F.col(key), seed) < test_size
    return df.filter(~in_test), df.filter(in_test)


def split_at_random(df: DataFrame, test_size: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Row-wise random split; it is repeatable only while the partitioning stays the same."""
    train, test = df.randomSplit([1.0 - test_size, test_size], seed)
    return train, test

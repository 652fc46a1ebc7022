"""Mixing sources to target weights.

Sizes are added up per source, targets follow from the weights, and each document is emitted floor(rate) times
plus once more with the probability of the fraction, decided by a seeded hash of its doc_id. Only one row per
source ever meets in one task; documents stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ebbtide.session import materialise

from .common import WORD, text_of

WEIGHTS = (5, 2, 1)
#: A source is repeated so often at most.
MOST = 3
SEED = 17


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Weights go to the sources by code point, null last, and repeat. The targets share the sum of all sizes by
    weight; none exceeds ``most`` times its source, and what it would have had above that is shared by weight
    among the rest: with the sources ordered by the level at which they fill up, running sums tell which do.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = by_source.select(
        "source", "source_size", (F.col("source_size") * most).cast("double").alias("most"),
        F.get(cycle, rank % len(weights)).alias("weight"))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    share = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    left = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    filled = ranked.select(
        "*", F.sum("source_size").over(every).cast("double").alias("total"),
        F.sum("weight").over(every).alias("weights"),
    ).withColumn("full", F.col("most") / F.col("weight") <= share / left)
    rest = F.col("total") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(every)
    open_weights = F.col("weights") - F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0.0)).over(every)
    # with every source full, as when all are empty, the level is never used
    level = rest / F.nullif(open_weights, F.lit(0.0))
    return filled.select(
        "source", "source_size",
        F.when(F.col("full"), F.col("most")).otherwise(level * F.col("weight")).alias("target"))


def copies(rate: Column, doc_id: Column, seed: int = SEED) -> Column:
    """floor(rate), plus one where the hash of doc_id falls below the fraction."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    # 52 bits of the hash make a number from 0 to below 1
    chance = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def plan(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and n_copies for every row of ``docs``.

    A null text has size 0; a null source is a source of its own. A source without words has target 0 and its
    documents no copies. Rows with the same doc_id and source share their fate. No rows give no rows.
    """
    sizes = materialise(docs.select("doc_id", "source", word_count(text_of()).alias("size")), "sizes")
    per_source = rates(sizes, weights, most)
    joined = sizes.alias("d").join(per_source.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    return joined.select(
        "d.doc_id", "d.source", "size", "source_size", "target", copies(F.col("rate"), F.col("d.doc_id"), seed).alias("n_copies"))


def rates(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """The targets with the repetition rate, stored: one small row per source, whose size Spark then knows."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return materialise(targets(sizes, weights, most).withColumn("rate", rate), "targets")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as ``plan`` says; all columns stay."""
    per_source = rates(docs.select("source", word_count(text_of()).alias("size")), weights, most)
    per_source = per_source.select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"))
    joined = docs.join(per_source, F.col("source").eqNullSafe(F.col("_mix_source")))
    times = F.sequence(F.lit(1).cast("long"), copies(F.col("_mix_rate"), F.col("doc_id"), seed))
    # sequence(1, 0) counts down, so rows without a copy go first
    some = joined.filter(copies(F.col("_mix_rate"), F.col("doc_id"), seed) > 0)
    return some.withColumn("_mix_copy", F.explode(times)).drop("_mix_source", "_mix_rate", "_mix_copy")

"""Grouping and encoding of customer attributes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, functions as F

from .joins import look_up, unique_lookup
from .ranks import with_rank

# Birth years of the age groups, both ends included.
AGE_GROUPS = {
    "boomers": (1946, 1964),
    "genX": (1965, 1980),
    "millennials": (1981, 1996),
    "genZ": (1997, 2005),
}
# The categories that are encoded.
CATEGORIES = [
    "CUSTOMER_SEGMENT", "PROVINCE_REGION", "MARITAL_GROUP", "COUNTRY_GROUP", "OCCUPATION_GROUP",
    "GENDER", "AGE_GROUP",
]


def bin_by_mapping(df: DataFrame, mapping: DataFrame, new_column: str, source: str) -> DataFrame:
    """Group the values of ``source`` by a mapping (``ORIGINAL``, ``REVISED``).

    Values without an entry, and nulls, become ``UNDEFINED``; nulls also in ``source`` itself.
    """
    lookup = unique_lookup(mapping, "ORIGINAL", "REVISED")
    undefined = F.lit("UNDEFINED")
    return look_up(df, lookup, source, new_column).withColumns({
        new_column: F.coalesce(new_column, undefined),
        source: F.coalesce(source, undefined),
    })


def age_group(birth_year: Column) -> Column:
    """Generation of a birth year; unknown years are ``Others``."""
    group = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, (first, last) in AGE_GROUPS.items():
        group = group.when(birth_year.between(first, last), name)
    return group.otherwise("Others")


def marital_group(status: Column) -> Column:
    """``MARRIED``, ``SINGLE`` or ``OTHER``."""
    return F.when(status.isin("MARRIED", "SINGLE"), status).otherwise("OTHER")


def country_group(country: Column) -> Column:
    """``VIETNAM`` or ``OTHER``."""
    return F.when(country == "VIETNAM", country).otherwise("OTHER")


def group_demographics(df: DataFrame, regions: DataFrame, occupations: DataFrame) -> DataFrame:
    """All group columns of the demographics table."""
    binned = bin_by_mapping(df, regions, "PROVINCE_REGION", "PROVINCE")
    binned = bin_by_mapping(binned, occupations, "OCCUPATION_GROUP", "OCCUPATION")
    return binned.withColumns({
        "AGE_GROUP": age_group(F.col("CUS_AGE")),
        "MARITAL_GROUP": marital_group(F.col("MARTIAL_STATUS")),
        "COUNTRY_GROUP": country_group(F.col("COUNTRY")),
    })


def _categories(df: DataFrame, columns: list[str], most: int) -> list[tuple[str, str]]:
    """The (column, value) pairs that occur, in column order, then value order, in one pass.

    They become columns of the schema and are held by the driver; a column with more than ``most`` is an
    error, not a cut.
    """
    long = df.select([F.col(c).cast("string") for c in columns]).unpivot([], columns, "name", "value")
    found = long.filter(F.col("value").isNotNull()).distinct()
    wide = [r["name"] for r in found.groupBy("name").count().filter(F.col("count") > most).collect()]
    if wide:
        raise ValueError(f"more than {most} categories in {', '.join(sorted(wide))}")
    found = found.collect()
    pairs = sorted((columns.index(row["name"]), row["value"]) for row in found)
    return [(columns[position], value) for position, value in pairs]


def category_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_index``, the most frequent value first, then by value; nulls come after all values.

    The index is a table of value counts, ranked and joined back: neither the driver nor a task holds all
    values.
    """
    for column in columns:
        counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(
            F.count("*").alias("_n"))
        # values of which two read the same are told apart by themselves
        order = [F.desc("_n"), F.col("_value").cast("string"), F.col("_value")]
        index = with_rank(counts, order, "_rank").select("_value", F.col("_rank").cast("double").alias(f"{column}_index"))
        nulls = counts.agg(F.count("*").cast("double").alias(f"{column}_index")).select(
            F.lit(None).cast(counts.schema["_value"].dataType).alias("_value"), f"{column}_index")
        lookup = index.unionByName(nulls)
        df = df.join(lookup, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")
    return df


def fit_category_vectors(df: DataFrame, columns: list[str], most: int = 1000) -> PipelineModel:
    """Index and one-hot stages with vector output ``<column>_encoded``; at most ``most`` values a column."""
    _categories(df, columns, most)
    return Pipeline(stages=[
        StringIndexer(
            inputCols=columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep"
        ),
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in columns],
            outputCols=[f"{c}_encoded" for c in columns],
        ),
    ]).fit(df)


@dataclass(frozen=True)
class OneHot:
    """The categories seen when fitting, as (column, value) in column order, then value order."""

    categories: tuple[tuple[str, str], ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add one 0/1 column ``<column>_<value>`` per category; unseen values get zeros only."""
        return df.withColumns({
            f"{c}_{value}": F.when(F.col(c) == value, 1).otherwise(0) for c, value in self.categories
        })


def fit_one_hot(df: DataFrame, columns: list[str], most: int = 1000) -> OneHot:
    """One 0/1 column for each category of the training table, at most ``most`` per column."""
    return OneHot(tuple(_categories(df, columns, most)))

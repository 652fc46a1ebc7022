"""Raw folders to the tables of a run: the newest month, its window, three delimited sources, a stored sample."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from .. import sources
from ..operators.sample import restrict_to_sample, sample_customers
from ..schemas import RAW_ACCOUNT, RAW_DEMOGRAPHICS, RAW_TRANSACTION
from .training_set import BankTables, Observation

SAMPLED = ["transactions", "accounts", "demographics"]


@dataclass(frozen=True)
class RawFolders:
    """Where the delimited files lie; transactions in one folder per month, ``YYYY_MM``."""

    transactions: str
    accounts: str
    demographics: str


def newest(spark: SparkSession, folders: RawFolders, observation: Observation) -> Observation:
    """``observation`` moved to the newest month that has a folder."""
    period = sources.latest_period_of_names(sources.list_folders(spark, folders.transactions)).first().period
    if period is None:
        raise FileNotFoundError(f"no month below {folders.transactions}")
    return replace(observation, year=period.year, month=period.month)


def fetch(
    spark: SparkSession, folders: RawFolders, observation: Observation, regions: DataFrame,
    occupations: DataFrame, translation: DataFrame, ignore_missing: bool = False,
) -> BankTables:
    """The tables of one observation; only the months of its window are opened.

    Headers may be in the original language and in any order.
    """
    bounds = sources.observation_bounds(
        observation.year, observation.month, observation.historical_months,
        observation.new_data, observation.monitoring,
    )
    return BankTables(
        sources.scan_months(spark, folders.transactions, RAW_TRANSACTION, *bounds, ignore_missing, translation),
        sources.read_csv(spark, folders.accounts, RAW_ACCOUNT, translation),
        sources.read_csv(spark, folders.demographics, RAW_DEMOGRAPHICS, translation),
        regions, occupations, translation,
    )


def sample_tables(
    spark: SparkSession, tables: BankTables, path: str, n: int, seed: int = 42, reuse: bool = False
) -> BankTables:
    """All three tables of ``n`` customers, stored below ``path``; with ``reuse`` the stored ones as they are."""

    def build() -> Mapping[str, DataFrame]:
        whole = {name: getattr(tables, name) for name in SAMPLED}
        return restrict_to_sample(whole, sample_customers(tables.transactions, n, seed))

    return replace(tables, **sources.sample_or_stored(spark, path, build, SAMPLED, reuse))

"""Raw bank tables to one labelled row per customer."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import month_index
from ..operators.accounts import clean_account_events, transform_accounts
from ..operators.churn import churn_label, merge_tables, with_churn_label
from ..operators.clean import drop_duplicates, parse_dates, translate
from ..operators.demographics import CATEGORIES, OneHot, fit_one_hot, group_demographics
from ..operators.panel import monthly_panel
from ..operators.sample import split_by_hash
from ..operators.trailing import trailing_features
from ..session import materialise
from ..sources import observation_bounds

Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class BankTables:
    """The raw tables and the three mappings."""

    transactions: DataFrame
    accounts: DataFrame
    demographics: DataFrame
    regions: DataFrame
    occupations: DataFrame
    translation: DataFrame


@dataclass(frozen=True)
class Observation:
    """The month that is looked at, and how far the history reaches back."""

    year: int
    month: int
    historical_months: int = 6
    new_data: bool = False
    monitoring: bool = False

    @property
    def has_label(self) -> bool:
        return self.monitoring or not self.new_data


def transactions_in_window(transactions: DataFrame, observation: Observation) -> DataFrame:
    """The months needed for one observation.

    Everything after this grows with the window, not with the history. The plain conditions on the
    two columns reach the scan; a table partitioned by them reads the window's files only.
    """
    first, last = observation_bounds(
        observation.year, observation.month, observation.historical_months,
        observation.new_data, observation.monitoring,
    )
    at = month_index(F.col("YEAR"), F.col("MONTH"))
    return transactions.filter(
        F.col("YEAR").between(first.year, last.year)
        & at.between(first.year * 12 + first.month, last.year * 12 + last.month)
    )


def transform_demographics(tables: BankTables) -> DataFrame:
    """Translated, distinct, dated and grouped customers."""
    clean = drop_duplicates(translate(tables.demographics, tables.translation))
    return group_demographics(
        parse_dates(clean, {"CIF_CREATE": "dd-MMM-yy"}), tables.regions, tables.occupations
    )


def transform_account_table(tables: BankTables) -> DataFrame:
    """Accounts per customer, from translated status events."""
    return transform_accounts(clean_account_events(translate(tables.accounts, tables.translation)))


def transform_transactions(
    tables: BankTables, demographics: DataFrame, observation: Observation,
    currency: str = "VND", mode: str = "rows",
) -> DataFrame:
    """The gap-filled panel of the observation's window."""
    window = transactions_in_window(tables.transactions, observation)
    window = drop_duplicates(translate(window, tables.translation))
    return monthly_panel(window, demographics, currency, mode)


def feature_table(
    tables: BankTables,
    observation: Observation,
    one_hot: OneHot | None = None,
    trailing_columns: Sequence[str] | None = None,
    keep: Keep = materialise,
    test_size: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, OneHot]:
    """One row per customer of the observation month: panel, accounts, demographics, trailing features.

    The label is joined where its look-ahead months are part of the window. The panel and the
    demographics have several readers and are written once. Without ``one_hot`` the categories are
    those of the customers that ``test_size`` and ``seed`` put into the training set, which must be those of
    the split that follows; new data gets the categories of the training run.
    """
    demographics = keep(transform_demographics(tables), "demographics")
    encoder = one_hot or fit_one_hot(split_by_hash(demographics, test_size, seed)[0], CATEGORIES)
    panel = keep(transform_transactions(tables, demographics, observation), "panel")
    trailing = trailing_features(
        panel, observation.year, observation.month, observation.historical_months,
        None if trailing_columns is None else list(trailing_columns),
    )
    merged = merge_tables(
        panel.drop("date"), transform_account_table(tables), encoder.transform(demographics),
        observation.year, observation.month, trailing,
    )
    if observation.has_label:
        merged = with_churn_label(merged, churn_label(panel), observation.year, observation.month)
    return merged, encoder

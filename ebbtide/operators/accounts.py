"""Account life-cycle: removal of anomalies and the number of accounts per customer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..schemas import ACCOUNT, ACCOUNT_COLUMNS, CUSTOMER
from ..session import materialise
from .clean import drop_duplicates, parse_dates
from .joins import match_keys
from .profile import removal_audit

# Text formats of the two dates.
DATE_PATTERNS = {"DATE_OF_STATUS": "dd-MMM-yy", "AC_CREATE": "yyyy-MM-dd"}


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the lowest by ``order``.

    Written as a minimum over the remaining columns, so that each task reduces its rows before the
    shuffle and a hot key arrives as a handful of rows. All columns must be in keys or order.
    """
    lowest = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("lowest"))
    return lowest.select(
        [F.col(f"lowest.{c}").alias(c) if c in order else F.col(c) for c in df.columns]
    )


def drop_status_before_creation(df: DataFrame) -> DataFrame:
    """A status cannot be older than its account; rows without one of the dates go too."""
    return df.filter(F.col("DATE_OF_STATUS") >= F.col("AC_CREATE"))


def keep_earliest_creation(df: DataFrame) -> DataFrame:
    """Of several creation dates for one status of an account, the earliest counts."""
    keys = [CUSTOMER, ACCOUNT, "STATUS_DESCRIPTION", "STATUS_ID", "PRODUCT_ID"]
    return keep_first(df, keys, ["AC_CREATE", "DATE_OF_STATUS"])


def drop_shared_accounts(df: DataFrame) -> DataFrame:
    """Remove accounts held by several customers, and everything else those customers hold."""
    shared = (
        df.groupBy(ACCOUNT).agg(F.count_distinct(CUSTOMER).alias("holders"))
        .filter(F.col("holders") > 1).select(ACCOUNT)
    )
    holders = match_keys(df, shared, ACCOUNT, "left_semi").select(CUSTOMER).distinct()
    unshared = match_keys(df, shared, ACCOUNT, "left_anti")
    return match_keys(unshared, holders, CUSTOMER, "left_anti")


def keep_one_product(df: DataFrame) -> DataFrame:
    """Of several products for one status event, the one created first, then the lowest id."""
    keys = [CUSTOMER, ACCOUNT, "STATUS_DESCRIPTION", "DATE_OF_STATUS"]
    return keep_first(df, keys, ["AC_CREATE", "PRODUCT_ID", "STATUS_ID"])


def account_dates(df: DataFrame) -> DataFrame:
    """One row per account: its first ``Active`` and ``Closed`` dates beside creation and product."""

    def first_date(status: str):
        return F.min(F.when(F.col("STATUS_DESCRIPTION") == status, F.col("DATE_OF_STATUS")))

    return df.groupBy(CUSTOMER, ACCOUNT).agg(
        F.min("AC_CREATE").alias("AC_CREATE"),
        F.min("PRODUCT_ID").alias("PRODUCT_ID"),
        first_date("Active").alias("Active"),
        first_date("Closed").alias("Closed"),
    )


def drop_active_after_closed(dates: DataFrame) -> DataFrame:
    """Remove accounts that were closed before they became active.

    Decision: accounts with only one of the dates stay, since the next step fills a missing
    ``Active``.
    """
    contradiction = F.coalesce(F.col("Active") > F.col("Closed"), F.lit(False))
    return dates.filter(~contradiction)


def fill_active(dates: DataFrame) -> DataFrame:
    """A missing ``Active`` is the day after creation."""
    return dates.withColumn("Active", F.coalesce("Active", F.date_add("AC_CREATE", 1)))


def accounts_per_customer(dates: DataFrame) -> DataFrame:
    """Accounts held by each customer, and how many have each attribute.

    Decision: named and counted the way later stages use it, ``No_of_Acc_Held`` for the accounts
    and ``num_of_<column>`` for values present.
    """
    return dates.groupBy(CUSTOMER).agg(
        F.count(ACCOUNT).alias("No_of_Acc_Held"),
        *[F.count(c).alias(f"num_of_{c}") for c in ("PRODUCT_ID", "AC_CREATE", "Active", "Closed")],
    )


def clean_account_events(raw: DataFrame) -> DataFrame:
    """Distinct rows, dates parsed, columns in order."""
    return parse_dates(drop_duplicates(raw), DATE_PATTERNS).select(*ACCOUNT_COLUMNS)


STEPS = {
    "status_before_creation": drop_status_before_creation,
    "several_creation_dates": keep_earliest_creation,
    "shared_accounts": drop_shared_accounts,
    "several_products": keep_one_product,
    "one_row_per_account": account_dates,
    "active_after_closed": drop_active_after_closed,
    "active_filled": fill_active,
}
#: Read three times by the step after it.
STORED = ("several_creation_dates",)


def account_steps(
    events: DataFrame, stored: tuple[str, ...] = STORED, keep: Callable[[DataFrame, str], DataFrame] = materialise
) -> dict[str, DataFrame]:
    """The table after every step, in order; those named in ``stored`` are written once."""
    df = keep(events, "input") if "input" in stored else events
    steps = {"input": df}
    for name, step in STEPS.items():
        df = step(df)
        steps[name] = df = keep(df, name) if name in stored else df
    return steps


def transform_accounts(events: DataFrame) -> DataFrame:
    """All removal steps, then one row per customer."""
    return accounts_per_customer(account_steps(events)["active_filled"])


def account_audit(events: DataFrame) -> DataFrame:
    """What each removal step took away. Every step is stored, so no step is computed twice."""
    return removal_audit(account_steps(events, ("input", *STEPS)))

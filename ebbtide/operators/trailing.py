"""Aggregates over the last 1, 2, ... h months before an observation month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import month_index
from ..schemas import CUSTOMER

# The columns that get trailing features, and the aggregates.
TRAILING_COLUMNS = [
    "NO_TRANSATION", "NO_TRANSATION_AUTO", "NO_DEPOSIT", "NO_ATM", "AMOUNT_TRANSACTION",
    "NO_INTEREST_PAYMENT", "NO_CREDIT", "NO_DEBIT", "No_of_Accounts", "NO_WITHDRAW",
    "NO_FEE_TRANSACTION", "PRE_CLS_BAL", "AMT_DEBIT", "NO_SMB", "AMT_CREDIT",
    "AMOUNT_TRANSACTION_AUTO", "NO_FUND_TRANSFER",
]
AGGREGATES = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "mean": lambda c: F.avg(F.col(c).cast("double")),
    "std": lambda c: F.stddev_samp(F.col(c).cast("double")),
}


def _running(panel: DataFrame, year: int, month: int, historical_months: int, names: list[str]) -> DataFrame:
    """One row per customer and month that has rows: ``age``, ``until`` and the aggregates of all months up to it.

    Windows are nested, so they are running aggregates from the youngest month on: every row enters each of them
    once, and a window that begins where a customer has no row is the one before it. A row of age ``a`` so stands
    for the windows of ``a + 1`` to ``until`` months. Narrow rows of the longest window are moved once, to the
    customer; there are at most ``historical_months`` of a panel's for one.
    """
    now = year * 12 + month
    at = month_index(F.col("YEAR"), F.col("MONTH"))
    oldest = now - historical_months + 1
    recent = panel.filter(F.col("YEAR").between((oldest - 1) // 12, year) & at.between(oldest, now)).select(
        CUSTOMER, *names, (F.lit(now) - at).alias("age"))
    by_age = Window.partitionBy(CUSTOMER).orderBy("age")
    running = by_age.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    older = F.lead("age").over(by_age)
    return recent.select(
        CUSTOMER, "age", older.alias("older"),
        *[f(c).over(running).alias(f"{c}_{suffix}") for c in names for suffix, f in AGGREGATES.items()],
    ).filter(F.col("older").isNull() | (F.col("older") > F.col("age"))).withColumn(
        "until", F.coalesce("older", F.lit(historical_months))).drop("older")


def trailing_long(
    panel: DataFrame, year: int, month: int, historical_months: int = 6,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per customer and window length, columns ``<column>_<aggregate>``.

    Rows are repeated for the windows they stand for after everything is summed up. The standard deviation of
    a single month is null.
    """
    names = columns or TRAILING_COLUMNS
    windows = F.explode(F.sequence(F.col("age") + 1, F.col("until")))
    values = [f"{c}_{suffix}" for c in names for suffix in AGGREGATES]
    return _running(panel, year, month, historical_months, names).select(CUSTOMER, windows.alias("months"), *values)


def trailing_features(
    panel: DataFrame, year: int, month: int, historical_months: int = 6,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per customer, columns ``<column>_l<i>m_<aggregate>``.

    Each window travels as one struct and finds its place by its length, which takes as many aggregates as there
    are windows and not as there are columns. The rows lie sorted by customer already: they neither move nor are
    sorted again. A customer without a row in a short window has nulls there.
    """
    names = columns or TRAILING_COLUMNS
    values = [f"{c}_{suffix}" for c in names for suffix in AGGREGATES]
    windows = range(1, historical_months + 1)
    held = _running(panel, year, month, historical_months, names).select(
        CUSTOMER, "age", "until", F.struct(*values).alias("window"))
    of_length = {i: F.when((F.col("age") < i) & (F.col("until") >= i), F.col("window")) for i in windows}
    wide = held.groupBy(CUSTOMER).agg(
        *[F.first(window, ignorenulls=True).alias(f"w{i}") for i, window in of_length.items()]
    )
    return wide.select(CUSTOMER, *[
        F.col(f"w{i}.{c}_{suffix}").alias(f"{c}_l{i}m_{suffix}")
        for i in windows for c in names for suffix in AGGREGATES
    ])

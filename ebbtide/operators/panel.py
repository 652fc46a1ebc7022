"""From weekly transactions to a gap-filled monthly panel, one row per customer and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import month_start
from ..schemas import ACCOUNT, BALANCE, CUSTOMER
from ..session import bounded_partitions
from .clean import numeric_columns, zero_fill
from .joins import match_keys

# Columns that identify a weekly row and are not summed.
NOT_SUMMED = ["YEAR", "MONTH", "WEEK", "HASHED_CIF", "HASHED_AC", "CCY"]


def keep_currency(df: DataFrame, currency: str, mode: str = "rows") -> DataFrame:
    """Keep the rows in ``currency``, or with ``mode='customers'`` the customers that use no other."""
    if mode == "rows":
        return df.filter(F.col("CCY") == currency)
    if mode != "customers":
        raise ValueError(f"unknown mode {mode}")
    return match_keys(df, _customers_with_other_currency(df, currency), CUSTOMER, "left_anti")


def _customers_with_other_currency(df: DataFrame, currency: str) -> DataFrame:
    return df.filter(F.col("CCY") != currency).select(CUSTOMER).distinct()


def other_currency_report(df: DataFrame, currency: str) -> DataFrame:
    """How many customers made a transaction in another currency."""
    others = df.filter(F.col("CCY") != currency)
    return others.agg(F.count_distinct(CUSTOMER).alias("customers_with_other_currency"))


def rollup_monthly(df: DataFrame) -> DataFrame:
    """Weekly rows per account to one row per customer and month.

    Every numeric column that does not identify the row is summed, balances too; accounts are
    counted. Rows are combined before each shuffle, so a customer with very many rows is no burden.
    """
    measures = numeric_columns(df, NOT_SUMMED)
    return df.groupBy("YEAR", "MONTH", CUSTOMER).agg(
        *[F.sum(c).alias(c) for c in measures],
        F.count_distinct(ACCOUNT).alias("No_of_Accounts"),
    )


def add_month_date(df: DataFrame) -> DataFrame:
    """``date``: the first of the month."""
    return df.withColumn("date", month_start(F.col("YEAR"), F.col("MONTH")))


def date_range(df: DataFrame) -> DataFrame:
    """First and last month of a table, from its ``YEAR`` and ``MONTH`` alone."""
    date = month_start(F.col("YEAR"), F.col("MONTH"))
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def range_bounds(df: DataFrame) -> tuple[Column, Column]:
    """The same two dates as scalar subqueries, to be used inside another query."""
    both = date_range(df)
    return both.select("min_date").scalar(), both.select("max_date").scalar()


def add_new_customer_flag(panel: DataFrame, demographics: DataFrame) -> DataFrame:
    """``new_customer_flag``: 1 in the month the customer was created, null if that is unknown.

    Decision: the creation date of a customer listed more than once is the earliest one, which
    keeps the panel at one row per customer and month.
    """
    created = demographics.groupBy(CUSTOMER).agg(F.min("CIF_CREATE").alias("CIF_CREATE"))
    same_month = F.trunc("CIF_CREATE", "month") == F.col("date")
    return panel.join(created, CUSTOMER, "left").withColumn("new_customer_flag", same_month.cast("int"))


def fill_month_gaps(
    panel: DataFrame,
    bounds: tuple[Column, Column] | None = None,
    attributes: Sequence[str] = ("CIF_CREATE",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Add a row for every month between the bounds in which a customer has none.

    Added rows have ``cif_missing_flag`` 1, the customer's ``attributes`` and null measures. Columns
    named in ``carry`` hold the last known value instead. Both ends of the range are included.

    Each row itself spreads over the months up to the customer's next row, and the first one also
    back to the start. So there is no customer-by-month table to join with: one shuffle of the real
    rows by customer, which later windows by customer use again. ``panel`` has one row per customer
    and month. The rows spread after the shuffle, so its parts are kept small.
    """
    bounded_partitions(panel.sparkSession)
    first, last = bounds or range_bounds(panel)
    by_month = Window.partitionBy(CUSTOMER).orderBy(F.col("date").asc_nulls_last())
    up_to_now = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    date = F.col("date")
    starts = F.lag(date).over(by_month).isNull() & date.isNotNull()
    spread = panel.withColumns({
        "spread_from": F.when(starts, F.least(first, date)).otherwise(date),
        "spread_to": F.coalesce(F.add_months(F.lead(date).over(by_month), -1), F.greatest(last, date)),
        **{c: F.last(c, ignorenulls=True).over(up_to_now) for c in carry},
    })
    months = F.sequence("spread_from", "spread_to", F.expr("interval 1 month"))
    grid = spread.withColumn("grid_date", F.explode_outer(months))
    real = F.col("grid_date").eqNullSafe(date)
    known = F.coalesce(F.col("grid_date") >= date, F.lit(True))

    def filled(c: str) -> Column:
        if c == CUSTOMER or c in attributes:
            return F.col(c)
        if c == "date":
            return F.col("grid_date").alias(c)
        if c in ("YEAR", "MONTH"):
            part = F.year("grid_date") if c == "YEAR" else F.month("grid_date")
            return F.coalesce(part, F.col(c)).alias(c)
        return F.when(known if c in carry else real, F.col(c)).alias(c)

    return grid.select(
        *[filled(c) for c in panel.columns], F.when(real, 0).otherwise(1).alias("cif_missing_flag")
    )


def carry_balance_forward(panel: DataFrame, column: str = BALANCE) -> DataFrame:
    """Fill a null balance with the customer's last known one."""
    up_to_now = Window.partitionBy(CUSTOMER).orderBy("date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return panel.withColumn(column, F.last(column, ignorenulls=True).over(up_to_now))


def drop_months_before_creation(panel: DataFrame) -> DataFrame:
    """Remove added rows of months before the customer was created.

    Decision: real rows stay whatever their date, and an unknown creation date removes nothing.
    """
    too_early = (F.col("cif_missing_flag") == 1) & (F.col("date") < F.trunc("CIF_CREATE", "month"))
    return panel.filter(~F.coalesce(too_early, F.lit(False)))


def finish_panel(panel: DataFrame) -> DataFrame:
    """Remaining numeric nulls become 0 and the helper dates go."""
    return zero_fill(panel).drop("date", "CIF_CREATE")


def monthly_panel(
    transactions: DataFrame,
    demographics: DataFrame,
    currency: str = "VND",
    mode: str = "rows",
    bounds: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Currency filter to gap-filled panel; ``date`` is kept for the windows that follow."""
    kept = keep_currency(transactions, currency, mode)
    monthly = add_new_customer_flag(add_month_date(rollup_monthly(kept)), demographics)
    # the range is read off the two period columns of the raw table, not off the rollup
    filled = fill_month_gaps(monthly, bounds or range_bounds(kept), carry=[BALANCE])
    return zero_fill(drop_months_before_creation(filled)).drop("CIF_CREATE")

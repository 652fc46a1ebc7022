"""The look-ahead churn label and the joins that build the modelling table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import CUSTOMER, TARGET
from .clean import drop_present, sanitize_columns

# Columns that are encoded elsewhere or of no use to a model.
NOT_MODELLED = [
    "PROVINCE", "PROVINCE_REGION", "OCCUPATION_GROUP", "OCCUPATION", "AGE_GROUP", "CUS_AGE",
    "MARITAL_GROUP", "MARTIAL_STATUS", "COUNTRY_GROUP", "COUNTRY", "CUSTOMER_SEGMENT", "GENDER",
    "BRANCH_ID", "num_of_AC_CREATE",
]
LOOK_AHEAD = ["NO_TRANSATION_n1m", "NO_TRANSATION_n2m", "NO_TRANSATION_n1m_n2m"]


def churn_label(panel: DataFrame, incomplete: str = "zero") -> DataFrame:
    """1 if the customer makes no transaction in the two months that follow, else 0.

    The last two months of a customer have no full look-ahead; there the sums are null and the
    label is 0, which does not say the customer stayed. ``incomplete='null'`` gives null instead.
    The window goes by customer, like the gap filling, so it adds no shuffle after that.
    """
    if incomplete not in ("zero", "null"):
        raise ValueError(f"unknown treatment {incomplete}")
    ahead = Window.partitionBy(CUSTOMER).orderBy("YEAR", "MONTH")
    quiet = F.col("NO_TRANSATION_n1m_n2m") == 0
    label = F.when(quiet, 1).otherwise(0)
    if incomplete == "null":
        label = F.when(F.col("NO_TRANSATION_n1m_n2m").isNotNull(), label)
    return (
        panel.select(CUSTOMER, "YEAR", "MONTH", "NO_TRANSATION")
        .withColumns({f"NO_TRANSATION_n{k}m": F.lead("NO_TRANSATION", k).over(ahead) for k in (1, 2)})
        .withColumn("NO_TRANSATION_n1m_n2m", F.col("NO_TRANSATION_n1m") + F.col("NO_TRANSATION_n2m"))
        .withColumn(TARGET, label)
        .select(CUSTOMER, "YEAR", "MONTH", *LOOK_AHEAD, TARGET)
    )


def churn_by_month(labels: DataFrame) -> DataFrame:
    """Customers on the books per month and how many of them are about to fall silent."""
    return labels.groupBy("YEAR", "MONTH").agg(
        F.count("*").alias("n_customers"), F.sum(TARGET).cast("bigint").alias("n_churned")
    )


def observed(df: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of the observation month."""
    return df.filter((F.col("YEAR") == year) & (F.col("MONTH") == month))


def with_account_counts(panel: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add ``No_of_Acc_Held``; customers without account information leave the table."""
    counts = accounts.select(CUSTOMER, "No_of_Acc_Held").filter(F.col("No_of_Acc_Held").isNotNull())
    return panel.join(counts, CUSTOMER, "inner")


def with_demographics(panel: DataFrame, demographics: DataFrame) -> DataFrame:
    """Add the customer attributes except the income; a customer listed twice counts once."""
    return panel.join(one_per_customer(demographics).drop("AVG_INCOME"), CUSTOMER, "left")


def one_per_customer(demographics: DataFrame) -> DataFrame:
    """Of several rows of a customer the one created first, then the first by its other values."""
    others = sorted(c for c in demographics.columns if c not in (CUSTOMER, "CIF_CREATE"))
    first = [F.col("CIF_CREATE").asc_nulls_last()] if "CIF_CREATE" in demographics.columns else []
    order = Window.partitionBy(CUSTOMER).orderBy(*first, *[F.col(f"`{c}`").asc_nulls_last() for c in others])
    return demographics.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def with_trailing(df: DataFrame, trailing: DataFrame) -> DataFrame:
    """Add the trailing features of the same observation month."""
    return df.join(trailing, CUSTOMER, "left")


def merge_tables(
    panel: DataFrame, accounts: DataFrame, demographics: DataFrame, year: int, month: int,
    trailing: DataFrame | None = None,
) -> DataFrame:
    """One row per customer of the observation month, with everything known about the customer.

    Decision: the month is filtered first, and the trailing features are joined, which is what the
    stage is for.
    """
    merged = with_demographics(with_account_counts(observed(panel, year, month), accounts), demographics)
    if trailing is not None:
        merged = with_trailing(merged, trailing)
    return drop_present(sanitize_columns(merged), NOT_MODELLED)


def with_churn_label(merged: DataFrame, labels: DataFrame, year: int, month: int) -> DataFrame:
    """Add the label of the observation month."""
    keys = [CUSTOMER, "YEAR", "MONTH"]
    return merged.join(observed(labels, year, month), keys, "left_outer").drop(*LOOK_AHEAD)

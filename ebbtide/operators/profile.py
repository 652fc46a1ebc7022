"""Reports about a table. Each is one aggregation, returned as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import human_format
from ..schemas import ACCOUNT, CUSTOMER, PREDICTED, TARGET


def missing_report(df: DataFrame) -> DataFrame:
    """(``column_name``, ``missing_value``, ``percentage_missing``) for columns that hold nulls.

    All columns are counted in one pass; the single resulting row is then turned on its side.
    NaN is a value, not a missing one. An empty table has an empty report.
    """
    counts = df.agg(
        F.count("*").alias("table rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    long = counts.unpivot("table rows", [f"`{c}`" for c in df.columns], "column_name", "missing_value")
    share = F.try_divide(F.col("missing_value"), F.col("table rows")) * 100
    return (
        long.filter(F.col("missing_value") > 0)
        .select("column_name", "missing_value", F.round(share, 2).alias("percentage_missing"))
        .orderBy("column_name")
    )


def flag_distribution(df: DataFrame, column: str, name: str) -> DataFrame:
    """Count and share of each value. Null rows count in the total but get no row."""
    counts = df.groupBy(column).agg(F.count("*").alias("actualCount"))
    total = df.agg(F.count("*")).scalar()
    share = F.round(F.col("actualCount") / total * 100, 1)
    return (
        counts.withColumn("percentage", F.concat(share.cast("string"), F.lit(" %")))
        .filter(F.col(column).isNotNull())
        .select(
            F.lit(name).alias("file_name"), column,
            human_format(F.col("actualCount")).alias("abbrCount"), "percentage", "actualCount",
        )
    )


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Width, length and column names of a table; the number of customers if it has any."""
    has_customers = CUSTOMER in df.columns
    measures = [F.count("*").alias("TotalRows")]
    if has_customers:
        # a missing id counts as one more customer
        measures.append(
            (F.count_distinct(CUSTOMER) + F.coalesce(F.max(F.col(CUSTOMER).isNull().cast("int")), F.lit(0)))
            .cast("bigint").alias("NumofCustomers")
        )
    customers = [
        human_format(F.col("NumofCustomers")).alias("NumofCustomersAbbr"), F.col("NumofCustomers"),
    ]
    return df.agg(*measures).select(
        F.lit(name).alias("file_name"),
        F.lit(len(df.columns)).alias("TotalColumns"),
        human_format(F.col("TotalRows")).alias("TotalRowsAbbr"),
        "TotalRows",
        F.lit(", ".join(df.columns)).alias("ColumnNames"),
        *(customers if has_customers else []),
    )


def stage_report(df: DataFrame, name: str) -> dict[str, DataFrame]:
    """What is looked at when a stage ends: ``profile``, ``missing``, and ``flags`` where the table has the label
    or its prediction, with the values of both as text."""
    report = {"profile": table_profile(df, name), "missing": missing_report(df)}
    flags = None
    for flag in (c for c in (TARGET, PREDICTED) if c in df.columns):
        part = flag_distribution(df, flag, name).select(
            "file_name", F.lit(flag).alias("flag"), F.col(flag).cast("string").alias("value"),
            "abbrCount", "percentage", "actualCount")
        flags = part if flags is None else flags.unionByName(part)
    return report if flags is None else {**report, "flags": flags}


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The combinations of values that occur."""
    return df.select(*columns).distinct()


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and how many different values each column has."""
    return df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_distinct(c).alias(f"n_{c}") for c in columns],
    )


def removal_audit(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, customers and accounts after each step, and how many the step removed."""
    parts = [
        df.agg(
            F.count("*").alias("n_rows"),
            F.count_distinct(CUSTOMER).alias("n_customers"),
            F.count_distinct(ACCOUNT).alias("n_accounts"),
        ).select(F.lit(number).alias("step_no"), F.lit(step).alias("step"), "*")
        for number, (step, df) in enumerate(steps.items())
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    order = Window.partitionBy().orderBy("step_no")  # one row per step
    return report.withColumns({
        f"{c}_dropped": F.coalesce(F.lag(c).over(order) - F.col(c), F.lit(0))
        for c in ("n_rows", "n_customers", "n_accounts")
    })

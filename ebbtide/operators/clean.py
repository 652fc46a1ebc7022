"""Cleaning steps that apply to any table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions import parse_date
from ..schemas import ACCOUNT, CUSTOMER
from .joins import look_up, unique_lookup


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of rows that agree in every column."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame, table: str) -> DataFrame:
    """Rows before and after dropping duplicates, from one aggregation over the whole row."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    totals = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count("*").alias("rows_after"),
    )
    dropped = F.col("rows_before") - F.col("rows_after")
    return totals.select(
        F.lit(table).alias("table_name"), "rows_before", "rows_after",
        dropped.alias("rows_dropped"),
        F.round(F.try_divide(100 * dropped, F.col("rows_before")), 2).alias("percentage_dropped"),
    )


def translate_columns(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rename the columns that the mapping lists as ``VN`` to its ``EN``.

    Only entries naming a column reach the driver, so their number is bounded by the table width.
    """
    lookup = unique_lookup(mapping.filter(F.col("VN").isin(df.columns)), "VN", "EN")
    renamed = {row.lookup_key: row.lookup_value for row in lookup.collect()}
    return df.select([F.col(f"`{c}`").alias(renamed.get(c, c)) for c in df.columns])


# Text columns that hold ids and dates, and so nothing to translate.
NOT_TRANSLATED = [CUSTOMER, ACCOUNT, "CIF_CREATE", "DATE_OF_STATUS", "AC_CREATE"]


def translate_values(df: DataFrame, mapping: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace string values that the mapping lists as ``VN`` by its ``EN``, in ``columns`` or in all text columns
    but ids and dates.

    Decision: a value is translated as a whole, never a part of it. The transaction table, known
    by its ``AMOUNT_TRANSACTION``, holds no text to translate and is returned as it is.
    """
    if "AMOUNT_TRANSACTION" in df.columns:
        return df
    lookup = unique_lookup(mapping, "VN", "EN")
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    texts = [c for c in texts if (c not in NOT_TRANSLATED if columns is None else c in columns)]
    out = df
    for name in texts:
        out = look_up(out, lookup, name, f"{name}__translated")
    return out.select([
        F.coalesce(f"{c}__translated", c).alias(c) if c in texts else F.col(c) for c in df.columns
    ])


def translate(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Column names, then values."""
    return translate_values(translate_columns(df, mapping), mapping)


def clean_name(name: str) -> str:
    """Every character that is no letter, digit, blank, line break or dot becomes ``_``; then blanks."""
    return re.sub(r"[^a-zA-Z0-9 \n.]", "_", name).replace(" ", "_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Clean all column names; two that become the same are an error."""
    names = [clean_name(name) for name in df.columns]
    if len({name.lower() for name in names}) < len(names):
        raise ValueError(f"column names collide after cleaning: {sorted(names)}")
    return df.toDF(*names)


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Project and reorder."""
    return df.select(*names)


def drop_present(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the columns that are there."""
    return df.drop(*names)


def parse_dates(df: DataFrame, patterns: dict[str, str], pivot_year: int | None = None) -> DataFrame:
    """Parse text columns in place, each by its pattern."""
    return df.withColumns({
        name: parse_date(F.col(name), pattern, pivot_year) for name, pattern in patterns.items()
    })


def zero_fill(df: DataFrame) -> DataFrame:
    """Numeric nulls become 0; flags, texts and dates stay."""
    return df.fillna(0)


def numeric_columns(df: DataFrame, without: list[str] | None = None) -> list[str]:
    skipped = set(without or [])
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in skipped
    ]

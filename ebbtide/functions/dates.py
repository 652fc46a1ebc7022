"""Calendar-month arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(year: Column, month: Column) -> Column:
    """First day of the month as a date."""
    return F.make_date(year, month, F.lit(1))


def month_index(year: Column, month: Column) -> Column:
    """Months counted on one line, so that a difference is a number of months."""
    return year * 12 + month


def parse_date(text: Column, pattern: str, pivot_year: int | None = None) -> Column:
    """Text to date; text that does not fit becomes null and shows up in the missing report.

    A two-digit year always means 20yy. With ``pivot_year`` a later year is put back by a century.
    """
    parsed = F.try_to_date(text, pattern)
    if pivot_year is None:
        return parsed
    return F.when(F.year(parsed) > pivot_year, F.add_months(parsed, -1200)).otherwise(parsed)

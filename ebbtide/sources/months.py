"""Monthly sources: which months exist, which are needed, and reading just those."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .tables import read_csv

FOLDER_NAME = r"^20\d{2}_\d{2}$"


def latest_period_of_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Newest month among folder names like ``2022_04``; names of another form are skipped."""
    month = F.try_to_date(F.col(column), "yyyy_MM")
    return names.filter(F.col(column).rlike(FOLDER_NAME)).agg(F.max(month).alias("period"))


def latest_period(df: DataFrame, date_column: str) -> DataFrame:
    """Newest month that has rows."""
    return df.agg(F.trunc(F.max(date_column), "month").alias("period"))


def list_folders(spark: SparkSession, root: str) -> DataFrame:
    """Names of the folders right below ``root``, on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    listing = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [(entry.getPath().getName(),) for entry in listing if entry.isDirectory()]
    return spark.createDataFrame(names, "name string")


def _shift(month: dt.date, by: int) -> dt.date:
    years, month_zero = divmod(month.year * 12 + month.month - 1 + by, 12)
    return dt.date(years, month_zero + 1, 1)


def observation_bounds(
    year: int, month: int, historical_months: int, new_data: bool = False, monitoring: bool = False
) -> tuple[dt.date, dt.date]:
    """First and last month to read for one observation month.

    The history reaches back ``historical_months`` months, the observation month included. Two
    months ahead are needed for the label, unless new data is scored without monitoring.
    """
    observed = dt.date(year, month, 1)
    ahead = 0 if new_data and not monitoring else 2
    return _shift(observed, 1 - historical_months), _shift(observed, ahead)


def observation_window(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """The months from ``first`` to ``last``, one row each."""
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("period"))


def in_window(date_column: str, first: dt.date, last: dt.date) -> Column:
    """Plain range on the column itself, so that it prunes partitions and row groups."""
    return (F.col(date_column) >= F.lit(first)) & (F.col(date_column) < F.lit(_shift(last, 1)))


def scan_months(
    spark: SparkSession,
    root: str,
    schema: StructType,
    first: dt.date,
    last: dt.date,
    ignore_missing: bool = False,
    translation: DataFrame | None = None,
) -> DataFrame:
    """Delimited files with a header line in folders ``<root>/YYYY_MM``, read as one table.

    Only the folders of the window are opened. A missing month is an error, unless
    ``ignore_missing`` is set, and so is a header that does not name the columns of the schema. Each month
    may have an order of its own.
    """
    span = (last.year - first.year) * 12 + last.month - first.month + 1
    wanted = [_shift(first, step).strftime("%Y_%m") for step in range(span)]
    # a listing of one root, not of its files: one name per month
    present = {row.name for row in list_folders(spark, root).filter(F.col("name").isin(wanted)).collect()}
    missing = [name for name in wanted if name not in present]
    if missing and not ignore_missing:
        raise FileNotFoundError(f"no folder below {root} for {', '.join(missing)}")
    paths = [f"{root}/{name}" for name in wanted if name in present]
    if not paths:
        return spark.createDataFrame([], schema)
    return read_csv(spark, paths, schema, translation)

"""A Python function per group, for what no built-in window or aggregate expresses."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def apply_per_group(
    df: DataFrame,
    keys: list[str],
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
) -> DataFrame:
    """Call ``function`` on the rows of each group and put the results together.

    A group is held by one Python process, whatever its size: whoever picks a function per group
    vouches for groups that fit, as a customer's months do. Windows know no such bound. Groups are dealt to
    a fixed number of tasks: the work goes by their number, and few bytes can be very many groups.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys).groupBy(*keys).applyInPandas(function, schema)

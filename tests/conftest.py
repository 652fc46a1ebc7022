import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ebbtide.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.log.level": "ERROR",
    })
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect

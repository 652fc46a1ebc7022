"""Whole tables by path."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.clean import translate_columns
from .delta import read_delta


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Any format the session has a reader for; ``delta`` also where its package is not on the classpath."""
    try:
        return spark.read.format(fmt).load(path)
    except (PySparkException, Py4JJavaError) as error:
        if fmt != "delta" or "DATA_SOURCE_NOT_FOUND" not in str(error):
            raise
    return read_delta(spark, path)


def read_csv_text(
    spark: SparkSession, path: str, schema: StructType, translation: DataFrame | None = None
) -> DataFrame:
    """The columns of ``schema`` as text, found by their names in the header, in any order.

    Names are translated first where there is a mapping (``VN``, ``EN``). A column that is missing, unknown or
    named twice is an error, and so is a file whose header differs from that of its neighbours below ``path``.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = StructType()
    for name in names:
        text = text.add(name, StringType())
    found = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    if translation is not None:
        found = translate_columns(found, translation)
    if sorted(found.columns) != sorted(schema.names):
        missing = sorted(set(schema.names) - set(found.columns))
        unknown = sorted(set(found.columns) - set(schema.names))
        raise ValueError(f"header of {path}: missing {missing}, unknown {unknown}, found {found.columns}")
    return found.select(schema.names)


def _parsed(schema: StructType) -> dict[str, Column]:
    return {f.name: F.col(f.name).try_cast(f.dataType) for f in schema if not isinstance(f.dataType, StringType)}


def unparsable_report(text: DataFrame, schema: StructType) -> DataFrame:
    """(``column_name``, ``n_unparsable``): fields of ``read_csv_text`` that are not of the declared type."""
    bad = {name: F.count_if(F.col(name).isNotNull() & parsed.isNull()) for name, parsed in _parsed(schema).items()}
    counts = text.agg(*[count.alias(name) for name, count in bad.items()])
    return counts.unpivot([], list(bad), "column_name", "n_unparsable")


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: StructType,
    translation: DataFrame | None = None, strict: bool = True,
) -> DataFrame:
    """Delimited files with a header line and declared types, columns found by name in every path.

    A field that is not of its type fails the query, or becomes null without ``strict``;
    ``unparsable_report`` counts such fields.
    """
    out = None
    for path in [paths] if isinstance(paths, str) else paths:
        part = read_csv_text(spark, path, schema, translation)
        out = part if out is None else out.unionByName(part)
    typed = _parsed(schema)
    if strict:
        for name, parsed in typed.items():
            wrong = F.col(name).isNotNull() & parsed.isNull()
            message = F.concat(F.lit(f"not a value of {name}: "), F.col(name))
            typed[name] = F.when(wrong, F.raise_error(message)).otherwise(parsed)
    return out.select([typed.get(name, F.col(name)).alias(name) for name in schema.names])


def write_table(df: DataFrame, path: str | None, name: str, csv: bool = False) -> str | None:
    """Overwrite ``<path>/<name>.parquet`` or ``.csv``; without a path nothing is written."""
    if not path:
        return None
    target = f"{path}/{name}.{'csv' if csv else 'parquet'}"
    writer = df.write.mode("overwrite")
    if csv:
        writer.option("header", True).csv(target)
    else:
        writer.parquet(target)
    return target


def sample_or_stored(
    spark: SparkSession, path: str, build: Callable[[], Mapping[str, DataFrame]],
    names: list[str], reuse: bool,
) -> dict[str, DataFrame]:
    """Rebuild the sample tables and store them, or read the stored ones untouched."""
    if not reuse:
        tables = build()
        for name in names:
            write_table(tables[name], path, name)
    return {name: read_table(spark, f"{path}/{name}.parquet") for name in names}

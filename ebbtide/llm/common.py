"""What the corpus operators share: text conventions, stable row ids, code that travels to workers."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbtide.session import materialise

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Identifies an input row, whatever its doc_id; no table of a user carries this name.
ROW = "_ebbtide_row"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored_rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written once, with a row id that every later scan sees unchanged.

    Rows are told apart even where doc_id is null or repeats.
    """
    bounded_batches(docs.sparkSession)
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Texts go to Python workers in batches of at most ``rows`` rows, so that long texts fit their memory.

    A smaller setting of the session stands.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


#: Bits of a map of wanted keys, 8 MB for any corpus; beyond as many keys it spares less, and loses none.
WANTED = 1 << 26


def likely(rows: DataFrame, key: Column, wanted: DataFrame, name: str, bits: int = WANTED) -> DataFrame:
    """``rows`` with a boolean column ``name``, true wherever ``key`` may be among the one column of ``wanted``.

    Wanted keys set bits of a map, in rows of 4 KB each that are aggregated on the executors and broadcast: at most
    ``bits`` / 8 bytes. Whoever reads the column moves few rows to an exact join, and none that must stay.
    """
    place = F.pmod(F.xxhash64(wanted.columns[0]), F.lit(bits))
    map_ = wanted.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    map_ = materialise(map_, "map")
    found = rows.withColumn("_place", F.pmod(F.xxhash64(key), F.lit(bits))).withColumn(
        "_own", F.bitmap_bucket_number("_place")).join(F.broadcast(map_), F.col("_own") == F.col("_bucket"), "left")
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = found.withColumn(name, F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False)))
    return found.drop("_place", "_own", "_bucket", "_bits")


def travels(module: str) -> None:
    """Send the functions of ``module`` to Python workers by value: workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from ebbtide import session

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def settings(spark):
    before = {name: spark.conf.get(name, None) for name in (ADVISORY, LEAST, PARTS)}
    for name in before:
        spark.conf.unset(name)
    yield spark.conf
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shuffles_are_read_in_small_parts(spark, settings):
    wide = spark.range(200_000).select((F.col("id") % 5000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))

    def parts():
        return len(wide.repartition("k").groupBy(F.spark_partition_id().alias("part")).agg(F.max("x")).collect())

    settings.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        assert parts() == 1
        session.bounded_partitions(spark)
        settings.set(ADVISORY, str(1 << 20))
        assert parts() > 4
    finally:
        settings.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")


def test_smaller_settings_stand(spark, settings):
    settings.set(ADVISORY, "1m")
    settings.set(PARTS, "3")
    session.bounded_partitions(spark)
    assert settings.get(ADVISORY) == "1m" and settings.get(PARTS) == "3" and settings.get(LEAST) == f"{session.LEAST_PARTITION}b"
    settings.unset(ADVISORY)
    settings.unset(PARTS)
    session.bounded_partitions(spark)
    assert settings.get(ADVISORY) == f"{session.PARTITION}b"
    assert int(settings.get(PARTS)) == 4 * int(settings.get("spark.sql.shuffle.partitions"))


def test_raw_rows_and_their_copies_come_from_one_scan(spark, tmp_path, rows):
    lines = [(1, 5, 1, "R", "F", 10.25), (1, 20, 2, "N", "O", 3.5), (2, 7, 1, "N", "F", 1.0), (2, 7, 1, "N", "F", 1.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, "
                          "l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT * FROM VALUES (1L, 50L, DATE '2001-01-09'), (2L, 7L, DATE '2001-02-01') AS t(o_orderkey, o_custkey, o_orderdate)"
              ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT * FROM VALUES (50L, 1.5D), (7L, 2.5D), (7L, 3.5D) AS t(c_custkey, c_acctbal)").write.parquet(f"{tmp_path}/customer.parquet")
    t = fixtures.Inputs(spark, str(tmp_path))
    clean = spark.sql(fixtures.FOR_SPARK["raw_transaction_clean"], lineitem=t.lineitem, orders=t.orders, customer=t.customer)
    text = fixtures.FOR_SPARK["raw_transaction"]
    found = spark.sql(text, raw_transaction_clean=clean)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
    given = spark.sql(fixtures.VIEWS["raw_transaction"], raw_transaction_clean=clean)
    assert rows(found) == rows(given) and found.count() == 5

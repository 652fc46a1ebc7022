import pytest
from pyspark.sql import functions as F

from ebbtide.operators import demographics, evaluate
from ebbtide.operators.ranks import range_of, with_rank


@pytest.mark.parametrize("partitions", [1, 7])
def test_ranks_over_many_partitions(spark, partitions):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("n"), (F.col("id") % 3).alias("k")).repartition(partitions)
    ranked = with_rank(df, [F.desc("k"), F.col("n")], "rank").orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(5000))
    assert [(r.k, r.n) for r in ranked] == sorted(((r.k, r.n) for r in ranked), key=lambda x: (-x[0], x[1]))
    assert with_rank(df.limit(0), [F.col("n")], "rank").collect() == []


@pytest.mark.parametrize("cuts", [[], [0.5], [0.1, 0.2, 0.3], [float(k) for k in range(20)]])
def test_ranges_by_binary_search(spark, cuts):
    values = [-1.0, 0.0, 0.1, 0.15, 0.5, 3.0, 18.5, 99.0, float("inf")]
    df = spark.createDataFrame([(v, cuts) for v in values], "v double, cuts array<double>")
    for most in (len(cuts), len(cuts) + 5):
        got = df.select("v", range_of(F.col("v"), F.col("cuts"), most).alias("at")).collect()
        assert {r.v: r["at"] for r in got} == {v: sum(c <= v for c in cuts) for v in values}


def test_a_curve_runs_no_job_before_it_is_asked_for(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("label"), (F.col("id") / 1000).alias("p"))
    spark.sparkContext.setJobGroup("curve", "curve")
    curve = evaluate.score_curve(df, "label", "p", ranges=5)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("curve")) == []
    assert curve.count() == 1000
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("curve")) != []


def test_only_counts_of_partitions_meet_in_one_task(spark):
    df = spark.range(100).select((F.col("id") % 9).cast("string").alias("a"))
    plan = demographics.category_index(df, ["a"])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and all("_part" in line for line in windows)

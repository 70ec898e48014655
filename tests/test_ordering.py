"""Skew-safe ordering operators equal their window-function definitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import (lag_in_groups, latest_per_key, number_in_groups,
                                         running_sum_in_groups, trailing_mean_in_groups)


def _hot_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    # group "hot" holds about a third of all rows
    rows = [("hot" if rnd.random() < 0.34 else f"g{rnd.randint(0, 40)}", rnd.randint(0, 500), i,
             float(rnd.randint(0, 100))) for i in range(n)]
    return spark.createDataFrame(rows, "g string, t int, id long, v double").repartition(5)


def test_number_in_groups_equals_row_number(spark):
    df = _hot_frame(spark)
    got = number_in_groups(df, ["g"], ["t", "id"], out="rn").select("id", "rn")
    w = Window.partitionBy("g").orderBy("t", "id")
    want = df.select("id", F.row_number().over(w).alias("rn"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_number_without_group_and_with_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 0)], "g string, t int")
    got = sorted((tuple(r) for r in number_in_groups(df, ["g"], ["t"]).collect()), key=repr)
    assert got == sorted([(None, 1, 1), (None, 3, 2), ("a", 0, 1), ("a", 2, 2)], key=repr)
    all_rows = number_in_groups(df, [], ["t"]).orderBy("t").select("rn").collect()
    assert [r.rn for r in all_rows] == [1, 2, 3, 4]


def test_running_sum_equals_window(spark):
    df = _hot_frame(spark)
    got = running_sum_in_groups(df, ["g"], ["t", "id"], {"v": "cv"}).select("id", "cv")
    w = Window.partitionBy("g").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(w).alias("cv"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_lag_and_trailing_mean(spark):
    df = _hot_frame(spark, 800)
    numbered = number_in_groups(df, ["g"], ["t", "id"], out="rn")
    got = trailing_mean_in_groups(lag_in_groups(numbered, ["g"], "rn", "v", "prev"),
                                  ["g"], "rn", "v", "ma3", 3).select("id", "prev", "ma3")
    w = Window.partitionBy("g").orderBy("t", "id")
    want = df.select("id", F.lag("v").over(w).alias("prev"),
                     F.avg("v").over(w.rowsBetween(-2, 0)).alias("ma3"))
    a = {r.id: (r.prev, round(r.ma3, 9)) for r in got.collect()}
    b = {r.id: (r.prev, round(r.ma3, 9)) for r in want.collect()}
    assert a == b


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 5, "z")],
                               "k int, t int, v string")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["t"], ["v"]).collect()}
    assert got == {1: "c", 2: "z"}


def test_bounded_groups_broadcast_summary_same_result(spark):
    df = _hot_frame(spark, 1500, seed=11)
    a = number_in_groups(df, ["g"], ["t", "id"], out="rn").select("id", "rn")
    b = number_in_groups(df, ["g"], ["t", "id"], out="rn", group_bound=50).select("id", "rn")
    assert sorted(a.collect()) == sorted(b.collect())
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan
    c = running_sum_in_groups(df, ["g"], ["t", "id"], {"v": "cv"}, group_bound=50).select("id", "cv")
    d = running_sum_in_groups(df, ["g"], ["t", "id"], {"v": "cv"}).select("id", "cv")
    assert sorted(c.collect()) == sorted(d.collect())


def test_hot_group_is_spread_over_partitions(spark):
    from tidemark.operators.ordering import _range_layout
    df = _hot_frame(spark, 6000, seed=3)
    # tiny data: keep AQE from merging the range partitions back into one
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        laid = _range_layout(df, ["g"], ["t", "id"])
        per_part = laid.filter(F.col("g") == "hot").groupBy("_tm_part").count().collect()
    finally:
        spark.conf.set(key, old)
    hot_rows = sum(r["count"] for r in per_part)
    assert hot_rows > 6000 * 0.3
    assert len(per_part) >= 2
    assert max(r["count"] for r in per_part) < hot_rows


def test_latest_per_key_aggregates_partially(spark):
    df = _hot_frame(spark, 500)
    plan = latest_per_key(df, ["g"], ["t", "id"], ["v"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_all_operators_over_many_partitions_with_payload(spark, coalesce):
    """Rows and summaries agree whatever adaptive execution merges, also when payload columns are used afterwards."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        df = _hot_frame(spark, 4000, 3).withColumn("payload", F.repeat(F.col("g"), 20))
        w = Window.partitionBy("g").orderBy("t", "id")
        numbered = number_in_groups(df, ["g"], ["t", "id"], out="rn")
        got = trailing_mean_in_groups(lag_in_groups(numbered, ["g"], "rn", "v", "prev"), ["g"], "rn", "v", "ma", 3)
        got = got.select("id", "rn", "prev", F.round("ma", 9).alias("ma"), F.length("payload").alias("n"))
        want = df.select("id", F.row_number().over(w).alias("rn"), F.lag("v").over(w).alias("prev"),
                         F.round(F.avg("v").over(w.rowsBetween(-2, 0)), 9).alias("ma"), F.length("payload").alias("n"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        sums = running_sum_in_groups(df, ["g"], ["t", "id"], {"v": "cv"}).select("id", "cv", "payload")
        exact = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cv"), "payload")
        assert sorted(sums.collect()) == sorted(exact.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

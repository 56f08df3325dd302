"""The spread join returns the plain join's rows, however the keys are distributed."""

from __future__ import annotations

from collections import Counter

import pytest
from cartwright.operators.joins import SkewPolicy, broadcastable, orphans, spread_join
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

FINE = SkewPolicy(rows_per_cell=3, hot_keys=2, always_spread=True)
TYPES = ("inner", "left", "left_semi", "left_anti")


def bag(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def frames(spark, left, right, other):
    return (
        spark.createDataFrame(left, "k string, a int").repartition(3),
        spark.createDataFrame(right, "k string, b int").repartition(2),
        spark.createDataFrame(other, "k string, c int").repartition(2),
    )


keys = st.sampled_from(["hot", "hot", "hot", "warm", "warm", "x", "y", "z", None])
sides = st.lists(st.tuples(keys, st.integers(0, 2)), max_size=40)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(left=sides, right=sides, other=sides)
def test_equals_plain_join(spark, left, right, other):
    a, b, c = frames(spark, left, right, other)
    for how in TYPES:
        assert bag(spread_join(a, b, "k", how, policy=FINE)) == bag(a.join(b, "k", how)), how
    both = a.join(b, "k", "left").join(c, "k", "left")
    assert bag(spread_join(a, [b, c], "k", "left", policy=FINE)) == bag(both)


def test_hot_on_both_sides_with_copies(spark):
    left = [("hot", 1)] * 30 + [("x", 1), (None, 1), (None, 1)]
    right = [("hot", 2)] * 20 + [("y", 2), (None, 2)]
    a, b, c = frames(spark, left, right, [("hot", 3)] * 7)
    for how in TYPES:
        assert bag(spread_join(a, b, "k", how, policy=FINE)) == bag(a.join(b, "k", how)), how
    both = a.join(b, "k", "left").join(c, "k", "left")
    assert bag(spread_join(a, [b, c], "k", "left", policy=FINE)) == bag(both)


def test_unique_left_side_is_not_counted(spark):
    a, b, c = frames(
        spark, [("hot", 1), ("x", 1), ("z", 1), (None, 1)], [("hot", 2)] * 30 + [("x", 2)], []
    )
    got = spread_join(a, b, "k", "left", policy=FINE, left_unique=True)
    assert bag(got) == bag(a.join(b, "k", "left"))


def test_hot_key_is_cut_into_cells(spark):
    left = spark.range(0, 3000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS k")
    right = spark.range(0, 3000, 1, 4).selectExpr("cast(id AS string) AS k", "id AS b")
    policy = SkewPolicy(rows_per_cell=100, always_spread=True)
    joined = spread_join(left, right.union(spark.sql("SELECT 'hot', -1L")), "k", "left", policy=policy)
    assert joined.count() == 3000
    assert joined.filter("b IS NULL").count() == 0


def test_a_third_of_all_rows_under_one_key_is_shared_by_all_tasks(spark):
    hot = "if(id % 3 = 0, 'hot', cast(id AS string)) AS k"
    left = spark.range(0, 30000, 1, 8).selectExpr(hot, "id AS a")
    right = spark.range(0, 9000, 1, 8).selectExpr("cast(id AS string) AS k", "id AS b")
    right = right.union(spark.sql("SELECT 'hot', -1L"))
    missing = left.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    policy = SkewPolicy(rows_per_cell=500, always_spread=True)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        for side in (left, missing):
            joined = spread_join(side, right, "k", "left", policy=policy)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 30000 and max(sizes) < 1.5 * 30000 / 4
    finally:
        spark.conf.set(setting, "true")


def test_small_sides_are_joined_without_spreading(spark):
    a = spark.sql("SELECT * FROM VALUES ('x', 1) AS t(k, a)")
    b = spark.sql("SELECT * FROM VALUES ('x', 2) AS t(k, b)")
    assert broadcastable(b.select("k"))
    plan = spread_join(a, b, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "__cell" not in plan


def test_limit_zero_or_disabled_means_not_broadcastable(spark):
    small = spark.sql("SELECT 'x' AS k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not broadcastable(small)
        a, b, c = frames(spark, [("x", 1)] * 5 + [(None, 1)], [("x", 2)], [("x", 3)] * 4)
        got = spread_join(a, [b, c], "k", "left", left_keys=a)
        assert bag(got) == bag(a.join(b, "k", "left").join(c, "k", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_orphans_keep_rows_without_key(spark):
    a, b, _ = frames(spark, [("x", 1), ("y", 1), (None, 1)], [("x", 1), (None, 2)], [])
    assert bag(orphans(a, b, "k")) == Counter({(1, "y"): 1, (1, None): 1})


def test_unknown_type_is_refused(spark):
    a, b, _ = frames(spark, [], [], [])
    with pytest.raises(ValueError):
        spread_join(a, b, "k", "full")

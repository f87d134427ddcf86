"""Plans that salt hot values, and outer joins of rows with a hot key."""

import pytest
from pyspark.sql import functions as F

from support import rows
from millrace.operators.joins import hot_keys, hot_safe_join
from millrace.operators.layout import by_value, plan_text, planned_repartition, salt_plan


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE 'k' || id END AS k", "id")


def test_hot_values_are_salted_by_their_counts(skewed):
    plan = {r["k"]: r["salts"] for r in salt_plan(skewed, "k", 12).collect()}
    assert plan["hot"] == 16 and set(plan) <= {"hot", None} and len(plan) < 3


def test_no_partition_is_much_larger_than_the_others(skewed):
    dealt = planned_repartition(skewed, "k", ["id"], salt_plan(skewed, "k", 12), 12)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2.5 * 30_000 / 12 and sum(sizes) == 30_000
    assert rows(dealt) == rows(skewed) and dealt.columns == skewed.columns
    placed = dealt.where("k <> 'hot'").withColumn("part", F.spark_partition_id())
    cold = placed.groupBy("k").agg(F.count_distinct("part").alias("p")).agg(F.max("p")).first()[0]
    assert cold == 1  # only what is hot is spread


def test_nothing_hot_and_nothing_at_all(spark):
    even = spark.range(5000).selectExpr("id AS k", "id")
    assert salt_plan(even, "k", 4).count() == 0
    none = even.limit(0)
    assert planned_repartition(none, "k", ["id"], salt_plan(none, "k", 4), 4).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_rows_of_a_hot_key_join_like_any_other(spark, skewed, how):
    right = spark.range(100).selectExpr("CASE WHEN id < 2 THEN 'hot' WHEN id < 4 THEN 'none' WHEN id < 6 THEN NULL ELSE 'k' || id END AS k", "id AS v")
    got = hot_safe_join(skewed, right, ["k"], how, hot_keys(skewed, ["k"]))
    want = skewed.join(right, ["k"], how)
    agg = lambda df: tuple(df.agg(F.count("*"), F.sum("id"), F.sum("v"), F.count("k")).first())
    assert agg(got) == agg(want)


def test_the_fact_is_dealt_without_a_sort_and_its_trips_only_once(spark, tmp_path, monkeypatch):
    from millrace.plans import warehouse

    trips = spark.range(60).selectExpr(
        "CAST(id AS string) AS trip_id", "id % 7 AS driver_id", "id AS rider_id", "1 AS pickup_zone_id", "2 AS dropoff_zone_id",
        "timestamp_seconds(id * 86400) AS request_time", "timestamp_seconds(id * 86400) AS pickup_time",
        "timestamp_seconds(id * 86400 + 60) AS dropoff_time", "1.5D AS distance_km", "10.0D AS fare", "'COMPLETED' AS status", "CAST(NULL AS string) AS cancel_reason")
    drivers = spark.createDataFrame([(i if i else None, 10 + i) for i in range(5)], "driver_id bigint, driver_key bigint")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "600"}
    old = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        fact = warehouse.fact_trips(trips, drivers)
        assert "BroadcastHashJoin" in plan_text(fact)
        monkeypatch.setattr(warehouse, "BROADCAST_DRIVERS", 4)
        shuffled = warehouse.fact_trips(trips, drivers)
        assert "BroadcastHashJoin" not in plan_text(shuffled) and rows(shuffled) == rows(fact)
        assert "hashpartitioning(trip_date" in plan_text(by_value(fact, "trip_date"))
        assert ", 200), REBALANCE" in plan_text(by_value(fact, "trip_date"))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    warehouse.write_partitioned(fact, f"{tmp_path}/fact", ["city", "trip_date"])
    assert rows(spark.read.parquet(f"{tmp_path}/fact").select(fact.columns)) == rows(fact)

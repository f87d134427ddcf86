"""The given tables seen as the entities of the jobs.

``events`` plays clickstream, log lines, visits, trip requests and driver
pings; ``lineitem`` plays trips; ``orders`` plays transactions and visits;
``customer`` plays employees.  Everything is derived per row by integer
arithmetic, so no mapping needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.geo import Zone, make_zones
from millrace.operators.dedup import union_events
from millrace.tables import read


def _plus_minutes(ts: str, minutes) -> "F.Column":
    return F.timestamp_seconds(F.unix_timestamp(ts) + minutes * 60)


def trips(spark: SparkSession, sf_dir: str, request_date: str | None = None) -> DataFrame:
    """Trips from lineitem.  ``request_date`` also prunes the scan by ship date."""
    li = read(spark, sf_dir, "lineitem")
    if request_date is not None:
        # A request falls on its ship date, which is always midnight.
        day = F.lit(request_date).cast("timestamp")
        li = li.where((F.col("l_shipdate") >= day) & (F.col("l_shipdate") < day + F.expr("INTERVAL 1 DAY")))
    zone = F.col("l_partkey") % 42
    rows = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trip_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_orderkey").alias("rider_id"),
        F.nullif(zone, F.lit(0)).cast("int").alias("pickup_zone_id"),
        (F.col("l_suppkey") % 40 + 1).cast("int").alias("dropoff_zone_id"),
        _plus_minutes("l_shipdate", (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 1440)
        .alias("request_time"),
        (F.col("l_partkey") % 12 + 1).alias("_wait"),
        (F.col("l_quantity").cast("bigint")
         - F.when(F.col("l_linenumber") == 7, 60).otherwise(0)).alias("_ride"),
        F.col("l_quantity").alias("distance_km"),
        F.col("l_extendedprice").alias("fare"),
        F.when(F.col("l_linestatus") == "F", "COMPLETED")
        .when(F.col("l_linestatus") == "O", "CANCELLED").alias("status"),
        F.when(F.col("l_returnflag") == "A", "RIDER_CANCEL")
        .when(F.col("l_returnflag") == "R", "DRIVER_CANCEL").alias("cancel_reason"))
    return (rows.withColumn("pickup_time", _plus_minutes("request_time", F.col("_wait")))
            .withColumn("dropoff_time", _plus_minutes("pickup_time", F.col("_ride")))
            .drop("_wait", "_ride"))


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks as trip requests."""
    ev = read(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click"))
    return ev.select("event_id", F.col("ts").alias("event_time"),
                     (F.col("user_id") % 40 + 1).cast("int").alias("zone_id"))


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups and purchases as free drivers, errors as drivers on a trip."""
    ev = read(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase", "error"))
    return ev.select("event_id", F.col("ts").alias("event_time"),
                     (F.col("user_id") % 40 + 1).cast("int").alias("zone_id"),
                     F.col("user_id").cast("string").alias("driver_id"),
                     F.when(F.col("event_type") == "error", "on_trip").otherwise("available").alias("status"),
                     (F.lit(17.0) + (F.col("event_id") * 7919 % 1000) / 1000).alias("lat"),
                     (F.lit(78.0) + (F.col("event_id") * 104729 % 1000) / 1000).alias("lon"))


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_events(raw_requests(spark, sf_dir), raw_pings(spark, sf_dir))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with a coordinate around the city box."""
    return read(spark, sf_dir, "events").select(
        "event_id", "user_id",
        (F.lit(17.0003) + (F.col("event_id") * 7919 % 1000) / 1000).alias("lat"),
        (F.lit(78.0003) + (F.col("event_id") * 104729 % 1000) / 1000).alias("lon"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings from signup values; many hours have none."""
    ev = read(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return (ev.groupBy(F.date_trunc("hour", "ts").alias("hour_ts"))
            .agg(F.max("value").alias("temp_c"), (F.min("value") / 8).alias("rain_mm")))


def zones() -> list[Zone]:
    return make_zones()


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text transactions; some fields are spoilt the way dirty files are."""
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        F.when(key % 97 == 0, " ").otherwise(key.cast("string")).alias("transaction_id"),
        F.when(key % 89 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(key % 83 == 0, "not-a-timestamp")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("transaction_timestamp"),
        F.when(key % 79 == 0, "not-a-number").when(key % 73 == 0, F.concat(F.lit("-"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"),
        F.when(key % 71 == 0, "").otherwise(F.col("o_orderpriority")).alias("category"),
        F.col("o_orderstatus").alias("status"))

"""Star schema and scan benchmark queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.geo import CITY, zone_table
from millrace.operators.quality import apply_rules, warehouse_trip_rules
from millrace.plans import mapping, trips, warehouse
from millrace.queries.demand import priced
from millrace.queries.registry import big, day, query
from millrace.queries.views import PRICED, WAREHOUSE_VALID, ZONES, with_
from millrace.session import shared_folder
from millrace.sinks.files import csv_copy, scanned_bytes
from millrace.tables import read

BENCH_MONTH = "1997-06"


def valid(spark, d, request_date=None):
    return apply_rules(mapping.trips(spark, d, request_date), warehouse_trip_rules())


def drivers(spark, d):
    """Suppliers as drivers."""
    return read(spark, d, "supplier").select(
        F.col("s_suppkey").alias("driver_id"), F.col("s_name").alias("name"),
        F.element_at(F.array(*[F.lit(v) for v in ("Auto", "Bike", "Mini", "Sedan", "SUV")]),
                     (F.col("s_nationkey") % 5 + 1).cast("int")).alias("vehicle_type"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("s_suppkey") % 1000).cast("int")).alias("joined_date"),
        F.lit(CITY).alias("home_city"), (F.lit(3) + F.col("s_suppkey") % 200 / 100).cast("decimal(3,2)").alias("rating"))


def zones(spark, d):
    """Zones in which trips start or end, with their attributes."""
    rows = valid(spark, d)
    seen = rows.select(F.explode(F.array("pickup_zone_id", "dropoff_zone_id")).alias("zone_id")).distinct()
    attributes = zone_table(spark).select("zone_id", "zone_name", F.col("kind").alias("borough"),
                                          F.col("latitude").alias("centroid_lat"), F.col("longitude").alias("centroid_lon"))
    return seen.join(attributes, "zone_id", "left")


def fact(spark, d, request_date=None):
    return warehouse.fact_trips(valid(spark, d, request_date), warehouse.dim_driver(drivers(spark, d)))


_DRIVERS = """
drivers AS (SELECT s_suppkey AS driver_id, s_name AS name,
                   CASE s_nationkey % 5 WHEN 0 THEN 'Auto' WHEN 1 THEN 'Bike' WHEN 2 THEN 'Mini' WHEN 3 THEN 'Sedan' ELSE 'SUV' END AS vehicle_type,
                   CAST(DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE) AS joined_date,
                   CAST(CAST(3 + s_suppkey % 200 / 100 AS DECIMAL(3,2)) AS DOUBLE) AS rating FROM supplier),
dim_driver AS (SELECT row_number() OVER (ORDER BY driver_id) AS driver_key, driver_id, sha256(name) AS name_hash, vehicle_type,
                      strftime(joined_date, '%Y-%m-%d') AS joined_date, 'Hyderabad' AS home_city, rating FROM drivers)"""
_FACT = WAREHOUSE_VALID + "," + _DRIVERS + """,
fact AS (SELECT trip_id, driver_key, rider_id, pickup_zone_id AS pickup_zone_key, dropoff_zone_id AS dropoff_zone_key,
                CAST(strftime(request_time, '%Y%m%d%H%M') AS BIGINT) AS time_key, status AS trip_status, cancel_reason, distance_km,
                epoch(dropoff_time - pickup_time) / 60 AS duration_min, CAST(fare AS DOUBLE) AS fare_inr,
                epoch(pickup_time - request_time) / 60 AS wait_time_min, 'Hyderabad' AS city,
                strftime(request_time, '%Y-%m-%d') AS trip_date
         FROM valid LEFT JOIN dim_driver USING (driver_id))"""
_DIM_TIME = """
dim_time AS (SELECT CAST(strftime(full_ts, '%Y%m%d%H%M') AS BIGINT) AS time_key, full_ts, strftime(full_ts, '%Y-%m-%d') AS date,
                    hour(full_ts) AS hour, minute(full_ts) AS minute, dayofweek(full_ts) + 1 AS day_of_week,
                    dayofweek(full_ts) IN (0, 6) AS is_weekend, false AS is_holiday,
                    hour(full_ts) IN (8, 9, 10, 17, 18, 19, 20) AS peak_flag
             FROM (SELECT DISTINCT date_trunc('minute', request_time) AS full_ts FROM valid))"""
_DIM_ZONE = ZONES + """,
dim_zone AS (SELECT zone_id AS zone_key, zone_id, zone_name, kind AS zone_type, 'Hyderabad' AS city,
                    latitude AS centroid_lat, longitude AS centroid_lon
             FROM (SELECT DISTINCT pickup_zone_id AS zone_id FROM valid UNION SELECT dropoff_zone_id FROM valid)
             LEFT JOIN zones USING (zone_id))"""


@query("dim_entity", with_(_DRIVERS) + "SELECT * FROM dim_driver")
def dim_entity(spark, d):
    return warehouse.dim_driver(drivers(spark, d)).withColumn("joined_date", day("joined_date"))


@query("dim_zone", with_(WAREHOUSE_VALID, _DIM_ZONE) + "SELECT * FROM dim_zone")
def dim_zone(spark, d):
    return warehouse.dim_zone(zones(spark, d)).withColumns({c: big(c) for c in ("zone_key", "zone_id")})


@query("dim_time", with_(WAREHOUSE_VALID, _DIM_TIME) + "SELECT * FROM dim_time")
def dim_time(spark, d):
    return warehouse.dim_time(valid(spark, d)).withColumns(
        {"date": day("date"), **{c: big(c) for c in ("hour", "minute", "day_of_week")}})


@query("fact_trips", with_(_FACT) + "SELECT * FROM fact")
def fact_trips(spark, d):
    return fact(spark, d).withColumns(
        {"trip_date": day("trip_date"), **{c: big(c) for c in ("pickup_zone_key", "dropoff_zone_key")}})


@query("warehouse_counts", with_(_FACT, _DIM_TIME, _DIM_ZONE) + """
SELECT 'dim_driver' AS table_name, count(*) AS rows FROM dim_driver UNION ALL SELECT 'dim_zone', count(*) FROM dim_zone
UNION ALL SELECT 'dim_time', count(*) FROM dim_time UNION ALL SELECT 'fact_trips', count(*) FROM fact""")
def warehouse_counts(spark, d):
    rows = valid(spark, d)
    return warehouse.table_counts({
        "dim_driver": warehouse.dim_driver(drivers(spark, d)), "dim_zone": warehouse.dim_zone(zones(spark, d)),
        "dim_time": warehouse.dim_time(rows), "fact_trips": fact(spark, d)})


_WRITTEN: dict[tuple[str, str], str] = {}


def written_fact(spark, d):
    """The fact written by city and month below the shared folder, once in a session; the folder goes with it.

    A day has only a few rows in these tables, hence months.
    """
    place = (spark.sparkContext.applicationId, d)
    if place not in _WRITTEN:
        path = shared_folder(spark, "fact")
        rows = fact(spark, d).withColumn("trip_month", F.date_format("trip_date", "yyyy-MM"))
        warehouse.write_partitioned(rows, path, ["city", "trip_month"])
        _WRITTEN[place] = path
    return _WRITTEN[place], spark.read.parquet(_WRITTEN[place])


@query("fact_partition_pruned", with_(_FACT) + """
SELECT trip_month, count(*) AS row_count, CAST(sum(CAST(fare_inr AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM (SELECT *, substr(trip_date, 1, 7) AS trip_month FROM fact) WHERE city = 'Hyderabad' AND trip_month LIKE '1997-%' GROUP BY 1""")
def fact_partition_pruned(spark, d):
    """One year read back from the partitioned fact."""
    written = written_fact(spark, d)[1]
    return (written.where((F.col("city") == CITY) & F.col("trip_month").startswith("1997-"))
            .groupBy("trip_month").agg(F.count(F.lit(1)).alias("row_count"),
                                       F.sum(F.col("fare_inr").cast("decimal(18,2)")).cast("double").alias("revenue")))


_BENCH = {
    "bench_q1": "SELECT pickup_zone_key, count(*) AS trips FROM month GROUP BY 1",
    "bench_q2": "SELECT driver_key, CAST(sum(CAST(fare_inr AS DECIMAL(18,2))) AS DOUBLE) AS revenue "
                "FROM month WHERE trip_status = 'COMPLETED' GROUP BY 1",
    "bench_q3": "SELECT pickup_zone_key, avg(wait_time_min) AS mean_wait FROM month GROUP BY 1",
    "bench_q4": "SELECT cancel_reason, count(*) AS trips FROM month WHERE trip_status = 'CANCELLED' GROUP BY 1",
    "bench_q5": "SELECT avg(distance_km) AS mean_km, "
                "CAST(sum(CAST(fare_inr AS DECIMAL(18,2))) AS DOUBLE) / count(fare_inr) AS mean_fare FROM month",
}


def _register_bench(name):
    sql = with_(_FACT) + f", month AS (SELECT * FROM fact WHERE substr(trip_date, 1, 7) = '{BENCH_MONTH}') " + _BENCH[name]

    @query(name, sql)
    def run(spark, d):
        """One partition of the written fact answers; the rest is not read."""
        out = warehouse.bench_query(written_fact(spark, d)[1], name, F.col("trip_month") == BENCH_MONTH)
        return out.withColumn("pickup_zone_key", big("pickup_zone_key")) if "pickup_zone_key" in out.columns else out
    return run


for _name in warehouse.QUESTIONS:
    _register_bench(_name)


@query("bench_scan_reduction", with_(_FACT) + "SELECT count(*) AS rows, true AS at_least_70_percent_less FROM fact")
def bench_scan_reduction(spark, d):
    """Bytes that a question reads: all of the row-format copy against one pruned partition."""
    _, written = written_fact(spark, d)
    path = shared_folder(spark, "copy")
    csv_copy(written, path)
    copy = spark.read.csv(path, header=True)
    full, pruned = scanned_bytes(copy), scanned_bytes(written.where(F.col("trip_month") == BENCH_MONTH))
    return copy.agg(F.count(F.lit(1)).alias("rows"), F.lit(pruned <= 0.3 * full).alias("at_least_70_percent_less"))


@query("bi_measures", with_(_FACT, PRICED) + """
SELECT avg(wait_time_min) AS avg_rider_eta, sum(duration_min) / (SELECT count(*) * CAST(600 AS DOUBLE) FROM dim_driver) AS driver_utilisation_rate,
       CAST(sum(CAST(fare_inr AS DECIMAL(18,2))) AS DOUBLE) / sum(distance_km) AS revenue_per_km,
       (SELECT CAST(sum(CAST(surge_multiplier AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM priced) AS current_avg_surge FROM fact""")
def bi_measures(spark, d):
    online = drivers(spark, d).select(F.lit(600.0).alias("online_minutes"))
    return trips.bi_measures(fact(spark, d), online, priced(spark, d))

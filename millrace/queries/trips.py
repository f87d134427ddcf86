"""Trip KPI, payout and overview queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.geo import zone_table
from millrace.operators.quality import apply_rules, lake_trip_rules, trip_rules
from millrace.plans import demand, mapping, trips
from millrace.queries.demand import priced, priced_once, windows
from millrace.queries.registry import SQL, big, day, query
from millrace.queries.views import LAKE_VALID, PINGS, PRICED, VALID, WINDOWS, ZONES, with_
from millrace.session import checkpointed, shared_folder
from millrace.sinks.files import report_csv
from millrace.sources.batch import csv_table


def valid(spark, d, rules=None):
    return apply_rules(mapping.trips(spark, d), rules or trip_rules())


@query("peak_hours", with_(VALID) + """
SELECT coalesce(hour(coalesce(request_time, pickup_time)), -1) AS hour, count(*) AS trips FROM valid GROUP BY 1""")
def peak_hours(spark, d):
    return trips.peak_hours(valid(spark, d))


@query("cancel_reasons", with_(VALID) + """
SELECT pickup_zone_id, hour(request_time) AS hour, coalesce(cancel_reason, 'UNKNOWN') AS cancel_reason, count(*) AS cancellations
FROM valid WHERE status = 'CANCELLED' GROUP BY 1, 2, 3""")
def cancel_reasons(spark, d):
    return trips.cancel_reasons(valid(spark, d))


_KPIS = """
kpis AS (SELECT pickup_zone_id, date_trunc('hour', request_time) AS hour_ts, count(*) AS requests,
                count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'CANCELLED') AS cancelled,
                avg(epoch(pickup_time - request_time) / 60) AS avg_eta_min, CAST(sum(fare) AS DOUBLE) AS revenue_inr,
                sum(distance_km) AS km FROM valid GROUP BY 1, 2)"""

# Trips and events lie years apart; the hourly surge figures are moved to the first trips.
_SHIFT_DAYS = 8000


def hourly_surge(spark, d):
    rows = demand.hourly_surge(priced(spark, d))
    return rows.withColumn("hour_ts", F.col("hour_ts") - F.make_dt_interval(days=F.lit(_SHIFT_DAYS)))


@query("zone_hour_kpis", with_(VALID, _KPIS, PRICED) + f"""
, surge AS (SELECT zone_id, date_trunc('hour', window_end) - INTERVAL {_SHIFT_DAYS} DAY AS hour_ts, sum(demand) / count(demand) AS avg_demand,
                  sum(drivers_available) / count(*) AS avg_supply,
                  CAST(sum(CAST(surge_multiplier AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_surge,
                  max(surge_multiplier) AS max_surge FROM priced GROUP BY 1, 2)
SELECT k.*, CASE WHEN km > 0 THEN revenue_inr / km END AS revenue_per_km, avg_demand, avg_supply, avg_surge, max_surge
FROM kpis k LEFT JOIN surge s ON s.zone_id = k.pickup_zone_id AND s.hour_ts = k.hour_ts""")
def zone_hour_kpis(spark, d):
    return (trips.zone_hour_kpis(valid(spark, d), hourly_surge(spark, d))
            .withColumn("pickup_zone_id", big("pickup_zone_id")))


@query("zone_hour_kpis_lake", with_(LAKE_VALID) + """
SELECT pickup_zone_id, date_trunc('hour', request_time) AS hour_ts, count(*) AS requests,
       avg(epoch(pickup_time - request_time) / 60) AS avg_eta_min, CAST(sum(fare) AS DOUBLE) AS revenue_inr, sum(distance_km) AS km
FROM valid GROUP BY 1, 2""")
def zone_hour_kpis_lake(spark, d):
    return (trips.zone_hour_kpis_lake(valid(spark, d, lake_trip_rules()))
            .withColumn("pickup_zone_id", big("pickup_zone_id")))


@query("revenue_per_km", with_(LAKE_VALID) + """
SELECT pickup_zone_id, hour(request_time) AS hour, CAST(sum(fare) AS DOUBLE) / greatest(sum(distance_km), 0.001) AS revenue_per_km
FROM valid GROUP BY 1, 2""")
def revenue_per_km(spark, d):
    return (trips.revenue_per_km(valid(spark, d, lake_trip_rules()))
            .withColumn("pickup_zone_id", big("pickup_zone_id")))


@query("driver_daily_utilisation", with_(PINGS) + """
SELECT driver_id, strftime(event_time, '%Y-%m-%d') AS date, count(*) FILTER (status = 'ON_TRIP') / count(*) AS utilisation,
       count(*) AS pings FROM pings GROUP BY 1, 2""")
def driver_daily_utilisation(spark, d):
    pings = mapping.raw_pings(spark, d).withColumn("status", F.upper("status"))
    return trips.driver_daily_utilisation(pings).withColumn("date", day("date"))


@query("driver_payout", with_(VALID) + """
, busy AS (SELECT date_trunc('hour', request_time) AS hour_ts FROM valid GROUP BY 1 HAVING count(*) >= 3),
done AS (SELECT v.*, b.hour_ts IS NOT NULL AS in_surge FROM valid v LEFT JOIN busy b ON b.hour_ts = date_trunc('hour', request_time)
         WHERE status = 'COMPLETED'),
per_driver AS (SELECT date_trunc('quarter', CAST(request_time AS TIMESTAMP)) AS period, driver_id, count(*) AS trips, CAST(sum(fare) AS DOUBLE) AS revenue_inr,
                      sum(epoch(dropoff_time - pickup_time) / 60) AS on_trip_min, count(*) FILTER (in_surge) AS surge_trips
               FROM done GROUP BY 1, 2),
rated AS (SELECT *, least(on_trip_min / 400, CAST(1 AS DOUBLE)) AS utilisation FROM per_driver),
paid AS (SELECT *, CAST(CASE WHEN utilisation >= CAST(0.78 AS DOUBLE) AND trips >= 12 THEN 150 ELSE 0 END AS DOUBLE) AS bonus_inr,
                surge_trips * CAST(10 AS DOUBLE) AS surge_pay_inr FROM rated)
SELECT *, bonus_inr + surge_pay_inr AS total_incentive_inr FROM paid""")
def driver_payout(spark, d):
    """Per driver and quarter, 400 minutes online; a surge hour has three trips or more."""
    rows = valid(spark, d)
    busy = (rows.groupBy(F.date_trunc("hour", "request_time").alias("hour_ts"))
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 3).select("hour_ts"))
    return trips.driver_payout(rows, F.date_trunc("quarter", "request_time"), checkpointed(busy),
                               trips.PayoutRule(online_minutes=400.0))


@query("payout_report", SQL["driver_payout"])
def payout_report(spark, d):
    """The payouts as a CSV report: as many files as the sorted result has partitions, so best paid comes first in them."""
    pay, path = driver_payout(spark, d), shared_folder(spark, "payouts")
    report_csv(pay, path, files=None)
    return csv_table(spark, path, pay.schema)


@query("kpi_summary", with_(VALID, WINDOWS) + """
, s AS (SELECT count(*) FILTER (status = 'COMPLETED') AS n, count(*) FILTER (status = 'CANCELLED') / count(*) AS cancel,
               avg(epoch(pickup_time - request_time) / 60) FILTER (status = 'COMPLETED') AS eta,
               CAST(sum(fare) FILTER (status = 'COMPLETED') AS DOUBLE) AS revenue,
               sum(distance_km) FILTER (status = 'COMPLETED') AS km FROM valid)
SELECT n AS completed_trips, round_even(cancel, 4) AS cancel_rate, round_even(eta, 2) AS avg_rider_eta_min,
       eta < 4.5 AS eta_target_met, revenue AS revenue_inr, round_even(revenue / km, 2) AS revenue_per_km_inr,
       (SELECT round_even(sum(drivers_on_trip) / sum(drivers_available + drivers_on_trip), 4) FROM windows) AS driver_utilisation
FROM s WHERE n > 0""")
def kpi_summary(spark, d):
    return trips.kpi_summary(valid(spark, d), windows=windows(spark, d))


@query("zone_overview", with_(VALID, _KPIS, PRICED, ZONES) + """
, t AS (SELECT pickup_zone_id AS zone_id, CAST(sum(requests) AS BIGINT) AS requests,
               CAST(sum(CAST(revenue_inr AS DECIMAL(18,2))) AS DOUBLE) AS revenue_inr, sum(km) AS km,
               CAST(sum(CAST(avg_eta_min AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS avg_eta_min FROM kpis GROUP BY 1),
latest AS (SELECT zone_id, demand, drivers_available AS supply, surge_multiplier, ratio FROM priced
           WHERE window_end = (SELECT max(window_end) FROM priced))
SELECT z.zone_id, zone_name, kind, latitude, longitude, demand_weight, requests, revenue_inr, km, avg_eta_min,
       CAST(floor(coalesce(l.demand, demand_weight * 25)) AS BIGINT) AS demand,
       CAST(floor(coalesce(l.supply, demand_weight * 22)) AS BIGINT) AS supply,
       coalesce(l.surge_multiplier, 1) AS surge_multiplier, coalesce(l.ratio, CAST(1.1 AS DOUBLE)) AS ratio
FROM zones z LEFT JOIN t USING (zone_id) LEFT JOIN latest l USING (zone_id)""")
def zone_overview(spark, d):
    rows = priced_once(spark, d)
    newest = rows.agg(F.max("window_end").alias("m")).scalar()
    latest = rows.where(F.col("window_end") == newest).withColumn("supply", F.col("drivers_available"))
    out = trips.zone_overview(zone_table(spark), trips.zone_hour_kpis(valid(spark, d)), latest)
    return out.select(big("zone_id").alias("zone_id"), "zone_name", "kind", "latitude", "longitude", "demand_weight",
                      "requests", "revenue_inr", "km", "avg_eta_min", "demand", "supply", "surge_multiplier", "ratio")

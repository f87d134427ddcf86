"""Sliding demand / supply, pricing and smoothing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.geo import zone_table
from millrace.plans import demand, mapping
from millrace.queries.registry import big, query
from millrace.queries.views import DRY, PRICED, WINDOWS, ZONES, with_
from millrace.session import checkpointed
from millrace.streaming.windows import tumbling_counts
from millrace.tables import read

# The events are sparse: six-hour windows every hour instead of five minutes every minute.
SIZE, SLIDE = 6 * 3600, 3600


def windows(spark, d):
    return demand.sliding_demand_supply(mapping.unified(spark, d), SIZE, SLIDE)


def windows_once(spark, d):
    """The windows (a few rows per zone and hour) computed once, for plans that read them often."""
    return checkpointed(windows(spark, d))


def priced(spark, d):
    return demand.price_windows(windows(spark, d), mapping.weather(spark, d))


def priced_once(spark, d):
    return checkpointed(priced(spark, d))


@query("tumbling_counts", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS count
FROM events GROUP BY ALL""")
def tumbling_counts_query(spark, d):
    return tumbling_counts(read(spark, d, "events"), "ts", "event_type", "1 hour")


@query("sliding_demand_supply", with_(WINDOWS) + """
SELECT zone_id, window_start, window_end, demand, drivers_available, drivers_on_trip FROM windows""")
def sliding_demand_supply(spark, d):
    return windows(spark, d).withColumn("zone_id", big("zone_id"))


@query("current_window", with_(WINDOWS, ZONES) + """,
newest AS (SELECT max(window_start) AS r FROM windows),
current_rows AS (SELECT * FROM (SELECT w.*, row_number() OVER (PARTITION BY zone_id ORDER BY window_end) AS rn
                                FROM windows w, newest WHERE window_end >= r) WHERE rn = 1)
SELECT z.zone_id, coalesce(window_end, r + INTERVAL 1 HOUR) AS window_end, coalesce(demand, 0) AS demand,
       coalesce(drivers_available, 0) AS supply, coalesce(drivers_on_trip, 0) AS on_trip
FROM zones z CROSS JOIN newest LEFT JOIN current_rows USING (zone_id)""")
def current_window(spark, d):
    out = demand.current_zones(windows_once(spark, d), zone_table(spark), SLIDE)
    return out.select(big("zone_id").alias("zone_id"), "window_end", "demand", "supply", "on_trip")


@query("surge_rules", with_(PRICED) + """
SELECT zone_id, window_end, demand, drivers_available, ratio, base_multiplier, weather_adjustment, surge_multiplier FROM priced""")
def surge_rules(spark, d):
    return priced(spark, d).select(big("zone_id").alias("zone_id"), "window_end", "demand", "drivers_available", "ratio",
                                   "base_multiplier", "weather_adjustment", "surge_multiplier")


@query("surge_smoothed", with_(PRICED) + """,
steps AS (
  SELECT zone_id, window_end, surge_multiplier, row_number() OVER w AS rn,
         coalesce(window_end - lag(window_end) OVER w > INTERVAL 10 HOUR, true) AS fresh
  FROM priced WINDOW w AS (PARTITION BY zone_id ORDER BY window_end)),
smooth AS (
  SELECT zone_id, rn, window_end, surge_multiplier, least(surge_multiplier, 3.0) AS smoothed FROM steps WHERE rn = 1
  UNION ALL
  SELECT s.zone_id, s.rn, s.window_end, s.surge_multiplier,
         round_even(least(CASE WHEN s.fresh THEN least(s.surge_multiplier, 3.0)
              WHEN least(s.surge_multiplier, 3.0) - p.smoothed > CAST(0.3 AS DOUBLE) THEN p.smoothed + CAST(0.3 AS DOUBLE)
              WHEN p.smoothed - least(s.surge_multiplier, 3.0) > CAST(0.3 AS DOUBLE) THEN p.smoothed - CAST(0.3 AS DOUBLE)
              ELSE least(s.surge_multiplier, 3.0) END, CAST(3.0 AS DOUBLE)), 2)
  FROM smooth p JOIN steps s ON s.zone_id = p.zone_id AND s.rn = p.rn + 1)
SELECT zone_id, window_end, surge_multiplier, smoothed FROM smooth""")
def surge_smoothed(spark, d):
    return demand.smooth_windows(priced(spark, d), SLIDE).withColumn("zone_id", big("zone_id"))


@query("surge_store_merge", with_(PRICED, DRY) + """,
both_sides AS (
  SELECT zone_id, window_end, surge_multiplier, demand, 0 AS change FROM dry
  UNION ALL SELECT zone_id, window_end, surge_multiplier, demand, 1 FROM priced WHERE hour(window_end) % 2 = 0),
merged AS (SELECT *, lpad(CAST(zone_id AS VARCHAR), 3, '0') || '#' || strftime(window_end, '%Y%m%d%H%M') AS row_key,
                  row_number() OVER (PARTITION BY zone_id, window_end ORDER BY change DESC) AS rn FROM both_sides)
SELECT row_key, zone_id, window_end, surge_multiplier, demand FROM merged
WHERE rn = 1 AND window_end > (SELECT max(window_end) FROM merged) - INTERVAL 7 DAY""")
def surge_store_merge(spark, d):
    """A store priced without weather takes in the even hours priced with it."""
    columns = ["zone_id", "window_end", "surge_multiplier", "demand"]
    w = windows_once(spark, d)
    store = demand.price_windows(w).select(*columns)
    rows = demand.price_windows(w, mapping.weather(spark, d)).where(F.hour("window_end") % 2 == 0).select(*columns)
    return demand.merge_store(store, rows).withColumn("zone_id", big("zone_id"))


@query("fleet_utilisation", with_(WINDOWS) + """
SELECT round_even(sum(drivers_on_trip) / sum(drivers_available + drivers_on_trip), 4) AS utilisation,
       sum(drivers_on_trip) / sum(drivers_available + drivers_on_trip) >= 0.78 AS target_met, count(*) AS windows_observed
FROM windows HAVING sum(drivers_available + drivers_on_trip) > 0""")
def fleet_utilisation(spark, d):
    return demand.fleet_utilisation(windows(spark, d))

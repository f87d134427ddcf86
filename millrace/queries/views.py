"""SQL for the derived entities: the text twin of ``plans.mapping``."""

TRIPS = """
trips AS (
  SELECT trip_id, driver_id, rider_id, pickup_zone_id, dropoff_zone_id, request_time,
         request_time + to_minutes(wait) AS pickup_time,
         request_time + to_minutes(wait) + to_minutes(ride) AS dropoff_time,
         distance_km, fare, status, cancel_reason
  FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trip_id,
               l_suppkey AS driver_id, l_orderkey AS rider_id,
               nullif(l_partkey % 42, 0) AS pickup_zone_id,
               l_suppkey % 40 + 1 AS dropoff_zone_id,
               l_shipdate + to_minutes((l_orderkey * 37 + l_linenumber * 101) % 1440) AS request_time,
               l_partkey % 12 + 1 AS wait,
               CAST(l_quantity AS BIGINT) - CASE WHEN l_linenumber = 7 THEN 60 ELSE 0 END AS ride,
               l_quantity AS distance_km,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS fare,
               CASE l_linestatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'CANCELLED' END AS status,
               CASE l_returnflag WHEN 'A' THEN 'RIDER_CANCEL' WHEN 'R' THEN 'DRIVER_CANCEL' END AS cancel_reason
        FROM lineitem))"""

VALID = TRIPS + """,
valid AS (
  SELECT * FROM trips
  WHERE pickup_zone_id BETWEEN 1 AND 40 AND dropoff_zone_id BETWEEN 1 AND 40
    AND (fare IS NULL OR fare >= 0)
    AND (pickup_time IS NULL OR dropoff_time IS NULL OR dropoff_time >= pickup_time))"""

WAREHOUSE_VALID = TRIPS + """,
valid AS (
  SELECT * FROM trips
  WHERE pickup_zone_id IS NOT NULL AND dropoff_zone_id IS NOT NULL
    AND (fare IS NULL OR fare >= 0)
    AND (pickup_time IS NULL OR dropoff_time IS NULL OR dropoff_time >= pickup_time))"""

LAKE_VALID = TRIPS + """,
valid AS (
  SELECT * FROM trips
  WHERE pickup_zone_id IS NOT NULL AND dropoff_zone_id IS NOT NULL
    AND (fare IS NULL OR fare >= 0)
    AND (pickup_time IS NULL OR pickup_time >= request_time)
    AND (pickup_time IS NULL OR dropoff_time IS NULL OR dropoff_time >= pickup_time))"""

REQUESTS = """
requests AS (
  SELECT event_id, ts AS event_time, user_id % 40 + 1 AS zone_id
  FROM events WHERE event_type IN ('view', 'click'))"""

PINGS = """
pings AS (
  SELECT event_id, ts AS event_time, user_id % 40 + 1 AS zone_id, CAST(user_id AS VARCHAR) AS driver_id,
         CASE WHEN event_type = 'error' THEN 'ON_TRIP' ELSE 'AVAILABLE' END AS status,
         CAST(17.0 AS DOUBLE) + (event_id * 7919 % 1000) / 1000 AS lat,
         CAST(78.0 AS DOUBLE) + (event_id * 104729 % 1000) / 1000 AS lon
  FROM events WHERE event_type IN ('signup', 'purchase', 'error'))"""

UNIFIED = REQUESTS + "," + PINGS + """,
unified AS (
  SELECT event_id, event_time, zone_id, 'request' AS kind, CAST(NULL AS VARCHAR) AS driver_id, CAST(NULL AS VARCHAR) AS status FROM requests
  UNION ALL
  SELECT event_id, event_time, zone_id, 'ping', driver_id, status FROM pings)"""

WINDOWS = UNIFIED + """,
windows AS (
  SELECT zone_id, window_start, window_start + INTERVAL 6 HOUR AS window_end,
         count(*) FILTER (WHERE kind = 'request') AS demand,
         count(DISTINCT driver_id) FILTER (WHERE status = 'AVAILABLE') AS drivers_available,
         count(DISTINCT driver_id) FILTER (WHERE status = 'ON_TRIP') AS drivers_on_trip
  FROM (SELECT u.*, date_trunc('hour', event_time) - to_hours(k) AS window_start
        FROM unified u, range(6) AS r(k))
  GROUP BY zone_id, window_start)"""

WEATHER = """
weather AS (
  SELECT date_trunc('hour', ts) AS hour_ts, max(value) AS temp_c, min(value) / 8 AS rain_mm
  FROM events WHERE event_type = 'signup' GROUP BY 1)"""


def _prices(name: str, columns: str, join: str = "") -> str:
    return f"""
{name} AS (
  SELECT *, round_even(base_multiplier + weather_adjustment, 2) AS surge_multiplier
  FROM (SELECT *, CAST(CASE WHEN exact_ratio < 1 THEN 1.0 WHEN exact_ratio < 1.5 THEN 1.2 WHEN exact_ratio < 2 THEN 1.5
                            WHEN exact_ratio <= 3 THEN 2.0 ELSE 2.5 END AS DOUBLE) AS base_multiplier,
               CAST(CASE WHEN rain_mm_h >= 2.5 THEN 0.2 ELSE 0 END
                    + CASE WHEN temp_c < 5 OR temp_c > 35 THEN 0.1 ELSE 0 END AS DOUBLE) AS weather_adjustment,
               round_even(exact_ratio, 3) AS ratio
        FROM (SELECT w.*, {columns},
                     CAST(demand AS DOUBLE) / greatest(drivers_available, 1) AS exact_ratio
              FROM windows w {join})))"""


PRICED = WINDOWS + "," + WEATHER + "," + _prices(
    "priced", "rain_mm AS rain_mm_h, temp_c", "LEFT JOIN weather ON hour_ts = date_trunc('hour', window_end)")
DRY = _prices("dry", "CAST(NULL AS DOUBLE) AS rain_mm_h, CAST(NULL AS DOUBLE) AS temp_c")

ZONES = """
zones AS (
  SELECT z AS zone_id, 'Zone ' || lpad(CAST(z AS VARCHAR), 2, '0') AS zone_name,
         CASE z % 3 WHEN 0 THEN 'business' WHEN 1 THEN 'residential' ELSE 'transit' END AS kind,
         (1720 + 10 * ((z - 1) // 8)) / 100 AS latitude, (7820 + 6 * ((z - 1) % 8)) / 100 AS longitude,
         (4 + z % 9) / 4 AS demand_weight
  FROM range(1, 41) AS r(z))"""

POSITIONS = """
positions AS (
  SELECT event_id, user_id, CAST(17.0003 AS DOUBLE) + (event_id * 7919 % 1000) / 1000 AS lat,
         CAST(78.0003 AS DOUBLE) + (event_id * 104729 % 1000) / 1000 AS lon FROM events)"""

TRANSACTIONS = """
raw AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN ' ' ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id,
         CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN o_orderkey % 83 = 0 THEN 'not-a-timestamp'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS transaction_timestamp,
         CASE WHEN o_orderkey % 79 = 0 THEN 'not-a-number'
              WHEN o_orderkey % 73 = 0 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CASE WHEN o_orderkey % 71 = 0 THEN '' ELSE o_orderpriority END AS category,
         o_orderstatus AS status
  FROM orders),
typed AS (
  SELECT *, try_cast(transaction_timestamp AS TIMESTAMP) AS transaction_time,
         try_cast(amount AS DOUBLE) AS amount_value FROM raw),
judged AS (
  SELECT *, coalesce(length(trim(transaction_id)) > 0 AND length(trim(customer_id)) > 0
                     AND length(trim(category)) > 0 AND transaction_time IS NOT NULL
                     AND amount_value >= 0, false) AS ok FROM typed),
clean AS (SELECT *, amount_value AS good_amount FROM judged WHERE ok)"""


def with_(*views: str) -> str:
    return "WITH RECURSIVE " + ",".join(views) + "\n"

"""Validation, gates and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.intervals import counted_within
from millrace.operators.joins import windows_with_events
from millrace.plans import mapping, transactions, trips
from millrace.queries.demand import SIZE, SLIDE, windows_once
from millrace.queries.registry import big, query
from millrace.queries.views import LAKE_VALID, PINGS, REQUESTS, TRANSACTIONS, TRIPS, VALID, WAREHOUSE_VALID, WINDOWS, with_
from millrace.tables import read


@query("reject_accounting", "WITH" + TRANSACTIONS + """
SELECT count(*) AS raw_rows, count(*) FILTER (ok) AS valid_rows, count(*) FILTER (NOT ok) AS rejected_rows FROM judged""")
def reject_accounting(spark, d):
    rows = transactions.typed(mapping.transactions(spark, d))
    return quality.reject_accounting(rows, quality.all_hold(quality.transaction_rules()))


_TRIP_COLUMNS = ["trip_id", "pickup_zone_id", "dropoff_zone_id", "request_time", "pickup_time", "dropoff_time", "status"]


def _trip_rows(df):
    return df.select(*_TRIP_COLUMNS).withColumns({c: big(c) for c in ("pickup_zone_id", "dropoff_zone_id")})


@query("valid_trips", with_(VALID) + f"SELECT {', '.join(_TRIP_COLUMNS)} FROM valid")
def valid_trips(spark, d):
    return _trip_rows(quality.apply_rules(mapping.trips(spark, d), quality.trip_rules()))


@query("valid_trips_warehouse", with_(WAREHOUSE_VALID) + f"SELECT {', '.join(_TRIP_COLUMNS)} FROM valid")
def valid_trips_warehouse(spark, d):
    return _trip_rows(quality.apply_rules(mapping.trips(spark, d), quality.warehouse_trip_rules()))


@query("valid_trips_lake", with_(LAKE_VALID) + f"SELECT {', '.join(_TRIP_COLUMNS)} FROM valid")
def valid_trips_lake(spark, d):
    return _trip_rows(quality.apply_rules(mapping.trips(spark, d), quality.lake_trip_rules()))


@query("expectations_report", with_(TRIPS, PINGS) + """
, t AS (SELECT pickup_zone_id IS NOT NULL AND dropoff_zone_id IS NOT NULL AS a, coalesce(fare IS NULL OR fare >= 0, false) AS b,
               coalesce(pickup_time IS NULL OR pickup_time >= request_time, false) AS c,
               coalesce(pickup_time IS NULL OR dropoff_time IS NULL OR dropoff_time >= pickup_time, false) AS d FROM trips),
p AS (SELECT coalesce(lat BETWEEN 17.10 AND 17.75 AND lon BETWEEN 78.15 AND 78.75, false) AS a, zone_id IS NOT NULL AS b FROM pings)
SELECT 'trips' AS layer, 'non_null_zone' AS rule, count(*) AS checked, count(*) FILTER (NOT a) AS violations FROM t
UNION ALL SELECT 'trips', 'fare_not_negative', count(*), count(*) FILTER (NOT b) FROM t
UNION ALL SELECT 'trips', 'pickup_after_request', count(*), count(*) FILTER (NOT c) FROM t
UNION ALL SELECT 'trips', 'dropoff_after_pickup', count(*), count(*) FILTER (NOT d) FROM t
UNION ALL SELECT 'pings', 'valid_gps', count(*), count(*) FILTER (NOT a) FROM p
UNION ALL SELECT 'pings', 'non_null_zone', count(*), count(*) FILTER (NOT b) FROM p""")
def expectations_report(spark, d):
    reports = [quality.violation_report(rows, rules).withColumn("layer", F.lit(layer)) for layer, rows, rules in (
        ("trips", mapping.trips(spark, d), quality.lake_trip_rules()),
        ("pings", mapping.raw_pings(spark, d), quality.lake_ping_rules()))]
    return reports[0].unionByName(reports[1]).select("layer", "rule", "checked", "violations")


@query("dq_gate_report", with_(VALID) + """
, kpis AS (SELECT pickup_zone_id, date_trunc('hour', request_time) AS hour_ts, count(*) AS requests,
                  count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'CANCELLED') AS cancelled
           FROM valid GROUP BY 1, 2)
SELECT count(*) AS rows_checked, count(*) FILTER (pickup_zone_id IS NULL) AS null_zone,
       count(*) FILTER (completed + cancelled <> requests) AS unbalanced, count(*) FILTER (requests <= 0) AS non_positive
FROM kpis""")
def dq_gate_report(spark, d):
    valid = quality.apply_rules(mapping.trips(spark, d), quality.trip_rules())
    return quality.kpi_gate_report(trips.zone_hour_kpis(valid))


def _raw_layer(spark, d):
    """Requests as they might arrive: some twice, some with a zone out of range or no time."""
    req = mapping.raw_requests(spark, d)
    bad_zone = F.when(F.col("event_id") % 50 == 0, 99).otherwise(F.col("zone_id"))
    bad_time = F.when(F.col("event_id") % 77 == 0, F.lit(None)).otherwise(F.col("event_time"))
    rows = req.withColumns({"zone_id": bad_zone, "event_time": bad_time})
    return rows.unionByName(rows.where(F.col("event_id") % 10 == 0))


_RAW_LAYER = REQUESTS + """,
once AS (SELECT event_id, CASE WHEN event_id % 77 = 0 THEN NULL ELSE event_time END AS event_time,
                CASE WHEN event_id % 50 = 0 THEN 99 ELSE zone_id END AS zone_id FROM requests),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE event_id % 10 = 0)"""


@query("silver_events", with_(_RAW_LAYER) + """
SELECT DISTINCT event_id, event_time, zone_id FROM raw WHERE zone_id BETWEEN 1 AND 40 AND event_time IS NOT NULL""")
def silver_events(spark, d):
    return quality.silver_events(_raw_layer(spark, d)).withColumn("zone_id", big("zone_id"))


@query("reconcile_layers", with_(_RAW_LAYER) + """
SELECT raw_rows, raw_rows - ids AS duplicates, ids - silver AS invalid, silver AS silver_rows,
       raw_rows - (raw_rows - ids) - (ids - silver) = silver AS balanced
FROM (SELECT count(*) AS raw_rows, count(DISTINCT event_id) AS ids,
             count(DISTINCT event_id) FILTER (zone_id BETWEEN 1 AND 40 AND event_time IS NOT NULL) AS silver FROM raw)""")
def reconcile_layers(spark, d):
    return quality.reconcile_layers(_raw_layer(spark, d))


@query("reconcile_windows", with_(WINDOWS) + """
SELECT w.zone_id, w.window_end, w.demand, count(r.event_id) AS recounted, w.demand = count(r.event_id) AS matched
FROM windows w LEFT JOIN requests r ON r.zone_id = w.zone_id AND r.event_time >= w.window_end - INTERVAL 6 HOUR
 AND r.event_time < w.window_end GROUP BY 1, 2, 3""")
def reconcile_windows(spark, d):
    """Every emitted window beside a recount from the raw requests."""
    emitted = windows_once(spark, d).select("zone_id", "window_end", "demand")
    recount = windows_with_events(emitted.select("zone_id", "window_end"), mapping.raw_requests(spark, d), "zone_id",
                                  "window_end", "event_time", SIZE, SLIDE)
    return (emitted.join(recount, ["zone_id", "window_end"])
            .select(big("zone_id").alias("zone_id"), "window_end", "demand", "recounted",
                    (F.col("demand") == F.col("recounted")).alias("matched")))


@query("reconcile_ranges", with_(REQUESTS) + """,
ranges AS (SELECT DISTINCT zone_id, event_time AS begins, event_time + to_minutes(event_id * 7919 % 9973 - 40) AS ends
           FROM requests WHERE event_id % 4 = 0)
SELECT r.zone_id, begins, ends, count(q.event_id) AS events
FROM ranges r LEFT JOIN requests q ON q.zone_id = r.zone_id AND q.event_time >= begins AND q.event_time < ends GROUP BY 1, 2, 3""")
def reconcile_ranges(spark, d):
    """Windows of any begin and length, some of them backwards, recounted from the raw requests."""
    requests = mapping.raw_requests(spark, d)
    length = F.make_dt_interval(mins=(F.col("event_id") * 7919 % 9973 - 40).cast("int"))
    ranges = requests.where("event_id % 4 = 0").select("zone_id", F.col("event_time").alias("begins"),
                                                       (F.col("event_time") + length).alias("ends"))
    return counted_within(ranges, requests, "zone_id", "begins", "ends", "event_time").withColumn("zone_id", big("zone_id"))


def _batches(spark, d):
    """Events as archived batches of 40 rows; every 23rd batch is missing, every 31st one short."""
    ev = read(spark, d, "events").select("event_id", F.floor(F.col("event_id") / 40).cast("bigint").alias("batch_id"))
    lost = (F.col("batch_id") % 23 == 7) | ((F.col("batch_id") % 31 == 5) & (F.col("event_id") % 40 == 3))
    return ev.where(~lost)


@query("batch_continuity", """
WITH kept AS (SELECT event_id // 40 AS batch_id FROM events
              WHERE NOT ((event_id // 40) % 23 = 7 OR ((event_id // 40) % 31 = 5 AND event_id % 40 = 3))),
sizes AS (SELECT batch_id, count(*) AS batch_rows FROM kept GROUP BY 1)
SELECT batch_id, batch_rows, lead(batch_id) OVER w AS next_batch, coalesce(lead(batch_id) OVER w <> batch_id + 1, false) AS gap_after,
       batch_rows <> 40 AS wrong_size FROM sizes WINDOW w AS (ORDER BY batch_id)""")
def batch_continuity(spark, d):
    return quality.batch_continuity(_batches(spark, d), "batch_id", 40)


@query("delivery_audit", """
WITH archive AS (SELECT event_id, event_id % 3 AS "partition", event_id // 3 AS "offset" FROM events WHERE event_id % 1000 <> 500),
parts AS (SELECT "partition", count(*) AS n, max("offset") - min("offset") + 1 AS span FROM archive GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS archived_rows, CAST(sum(span) AS BIGINT) AS offset_delta,
       (SELECT count(DISTINCT event_id) FROM archive) AS unique_ids, CAST(sum(n) AS BIGINT) AS acked, CAST(0 AS BIGINT) AS failed,
       sum(n) = sum(span) AND sum(span) = (SELECT count(DISTINCT event_id) FROM archive) AS exactly_once FROM parts""")
def delivery_audit(spark, d):
    """Three partitions with an offset lost now and then."""
    archive = (read(spark, d, "events").where(F.col("event_id") % 1000 != 500)
               .select("event_id", (F.col("event_id") % 3).alias("partition"),
                       F.floor(F.col("event_id") / 3).cast("bigint").alias("offset")))
    return quality.delivery_audit(archive)

"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as s
from millrace.functions.geo import haversine_km, in_box, zone_table
from millrace.operators.joins import resolved
from millrace.operators.nearest import nearest
from millrace.plans import mapping
from millrace.queries.registry import big, day, query
from millrace.queries.views import POSITIONS, TRIPS, ZONES, with_
from millrace.tables import read


@query("scalar_math", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round_even(l_partkey / 16, 3) AS half_even, greatest(0.0, l_quantity - 25) AS floored,
       least(l_quantity / 40, 1.0) AS clipped, ((l_linenumber - 5) % 8 + 8) % 8 AS salt,
       l_quantity * CAST(1.60934 AS DOUBLE) AS km
FROM lineitem""")
def scalar_math(spark, d):
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.bround(F.col("l_partkey") / 16, 3).alias("half_even"),
        F.greatest(F.lit(0.0), F.col("l_quantity") - 25).alias("floored"),
        F.least(F.col("l_quantity") / 40, F.lit(1.0)).alias("clipped"),
        F.pmod(F.col("l_linenumber") - 5, F.lit(8)).alias("salt"), s.miles_to_km(F.col("l_quantity")).alias("km"))


@query("scalar_null", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, o_orderpriority, 'none') AS first_known
FROM orders""")
def scalar_null(spark, d):
    return read(spark, d, "orders").select(
        "o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority", F.lit("none"))
        .alias("first_known"))


@query("scalar_string", """
SELECT p_partkey, upper(p_name) AS name_upper, length(trim('  ' || p_name || ' ')) AS name_length,
       length(trim(CASE WHEN p_partkey % 5 = 0 THEN '   ' ELSE p_brand END)) > 0 AS filled FROM part""")
def scalar_string(spark, d):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    brand = F.when(F.col("p_partkey") % 5 == 0, "   ").otherwise(F.col("p_brand"))
    return read(spark, d, "part").select(
        "p_partkey", F.upper("p_name").alias("name_upper"), big(F.length(F.trim(padded))).alias("name_length"),
        s.not_blank(brand).alias("filled"))


@query("describe_row", """
SELECT c_custkey, c_name || ' works in ' || c_mktsegment || ' with ' || c_nationkey || ' years experience' AS description
FROM customer""")
def describe_row(spark, d):
    return read(spark, d, "customer").select(
        "c_custkey", F.format_string("%s works in %s with %d years experience", "c_name", "c_mktsegment", "c_nationkey")
        .alias("description"))


@query("surge_row_key", """
SELECT event_id, lpad(CAST(user_id % 40 + 1 AS VARCHAR), 3, '0') || '#' || strftime(ts, '%Y%m%d%H%M') AS row_key FROM events""")
def surge_row_key(spark, d):
    return read(spark, d, "events").select("event_id", s.store_key(F.col("user_id") % 40 + 1, F.col("ts")).alias("row_key"))


@query("resolve_dimension", """
SELECT wanted, coalesce((SELECT min(p_partkey) FROM part WHERE CAST(p_partkey AS VARCHAR) = trim(wanted)),
                        (SELECT min(p_partkey) FROM part WHERE contains(lower(p_type || ' ' || p_name), lower(trim(wanted))))) AS part_key
FROM (SELECT DISTINCT '  ' || upper(substr(p_type, 2, 4)) || ' ' AS wanted FROM part
      UNION SELECT DISTINCT substr(p_name, 3, 6) FROM part UNION SELECT DISTINCT substr(p_type, 1, 2) FROM part
      UNION SELECT DISTINCT ' ' || l_partkey FROM lineitem UNION SELECT 'no such part ' || s_nationkey FROM supplier)""")
def resolve_dimension(spark, d):
    """Partial, padded, mixed-case and numeric terms against all names; the lowest id wins, unknown terms stay null."""
    part = read(spark, d, "part")
    padded = F.concat(F.lit("  "), F.upper(F.substring("p_type", 2, 4)), F.lit(" "))
    terms = [part.select(padded.alias("wanted")), part.select(F.substring("p_name", 3, 6).alias("wanted")),
             part.select(F.substring("p_type", 1, 2).alias("wanted")),
             read(spark, d, "lineitem").select(F.concat(F.lit(" "), "l_partkey").alias("wanted")),
             read(spark, d, "supplier").select(F.concat(F.lit("no such part "), "s_nationkey").alias("wanted"))]
    wanted = terms[0]
    for more in terms[1:]:
        wanted = wanted.unionAll(more)
    names = part.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_type", "p_name").alias("name"))
    return resolved(wanted.distinct(), "wanted", names).withColumnRenamed("id", "part_key")


@query("scalar_time", """
SELECT o_orderkey, try_cast(t AS TIMESTAMP) AS parsed, strftime(try_cast(t AS TIMESTAMP), '%Y-%m-%d') AS day,
       date_trunc('minute', stamp) AS minute_ts, date_trunc('hour', stamp) AS hour_ts
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS t,
             o_orderdate + to_seconds(o_orderkey * 97 % 86400) AS stamp FROM orders)""")
def scalar_time(spark, d):
    o = read(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    stamp = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + F.col("o_orderkey") * 97 % 86400)
    return o.select("o_orderkey", parsed.alias("parsed"), day(F.to_date(parsed)).alias("day"),
                    F.date_trunc("minute", stamp).alias("minute_ts"), F.date_trunc("hour", stamp).alias("hour_ts"))


@query("bin_30min", "SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts) AS bin FROM events")
def bin_30min(spark, d):
    return read(spark, d, "events").select("event_id", s.floor_to(F.col("ts"), 1800).alias("bin"))


@query("time_parts", """
SELECT event_id, hour(ts) AS hour, minute(ts) AS minute, dayofweek(ts) + 1 AS day_of_week, (dayofweek(ts) + 6) % 7 AS weekday,
       dayofweek(ts) IN (0, 6) AS is_weekend, hour(ts) IN (8, 9, 10, 17, 18, 19, 20) AS peak_flag FROM events""")
def time_parts(spark, d):
    ts = F.col("ts")
    return read(spark, d, "events").select(
        "event_id", big(F.hour(ts)).alias("hour"), big(F.minute(ts)).alias("minute"),
        big(F.dayofweek(ts)).alias("day_of_week"), big(F.weekday(ts)).alias("weekday"),
        s.is_weekend(ts).alias("is_weekend"), s.is_peak(ts).alias("peak_flag"))


@query("time_key", "SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS time_key FROM events")
def time_key(spark, d):
    return read(spark, d, "events").select("event_id", s.minute_key(F.col("ts")).alias("time_key"))


@query("duration_minutes", with_(TRIPS) + """
SELECT trip_id, epoch(dropoff_time - pickup_time) / 60 AS duration_min, epoch(pickup_time - request_time) / 60 AS wait_time_min
FROM trips""")
def duration_minutes(spark, d):
    return mapping.trips(spark, d).select(
        "trip_id", s.minutes_between(F.col("pickup_time"), F.col("dropoff_time")).alias("duration_min"),
        s.minutes_between(F.col("request_time"), F.col("pickup_time")).alias("wait_time_min"))


@query("hash_names", "SELECT s_suppkey, sha256(s_name) AS name_hash FROM supplier")
def hash_names(spark, d):
    return read(spark, d, "supplier").select("s_suppkey", F.sha2("s_name", 256).alias("name_hash"))


@query("scalar_cast", """
SELECT o_orderkey, try_cast(t AS DOUBLE) AS number, coalesce(try_cast(t AS DOUBLE), 0) AS number_or_zero,
       CAST(o_orderstatus = 'F' AS BIGINT) AS finished, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS t FROM orders)""")
def scalar_cast(spark, d):
    text = F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    return read(spark, d, "orders").select(
        "o_orderkey", text.try_cast("double").alias("number"), s.number_or_zero(text).alias("number_or_zero"),
        big(F.col("o_orderstatus") == "F").alias("finished"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("amount"))


@query("haversine", with_(POSITIONS) + """
SELECT event_id, round(12742 * asin(sqrt(0.5 - cos((CAST(17.4 AS DOUBLE) - lat) * p) / 2
         + cos(lat * p) * cos(CAST(17.4 AS DOUBLE) * p) * (1 - cos((CAST(78.45 AS DOUBLE) - lon) * p)) / 2)), 6) AS km
FROM positions, (SELECT pi() / 180 AS p)""")
def haversine(spark, d):
    km = haversine_km(F.col("lat"), F.col("lon"), F.lit(17.4), F.lit(78.45))
    return mapping.positions(spark, d).select("event_id", F.round(km, 6).alias("km"))


@query("resolve_supplier", """
SELECT wanted, (SELECT min(s_suppkey) FROM supplier WHERE contains(lower(s_name), lower(trim(wanted)))) AS supplier_key
FROM (SELECT DISTINCT ' ' || upper(substr(s_name, 1 + s_suppkey % 14)) AS wanted FROM supplier
      UNION SELECT DISTINCT substr(s_name, 5, 9) FROM supplier UNION SELECT 'Supplier#x' || s_nationkey FROM supplier)
WHERE try_cast(trim(wanted) AS BIGINT) IS NULL""")
def resolve_supplier(spark, d):
    """Names that all begin alike: a term's rarest piece finds its candidates."""
    supplier = read(spark, d, "supplier")
    cut = F.col("s_name").substr(F.lit(1) + (F.col("s_suppkey") % 14).cast("int"), F.length("s_name"))
    wanted = (supplier.select(F.concat(F.lit(" "), F.upper(cut)).alias("wanted"))
              .unionAll(supplier.select(F.substring("s_name", 5, 9)))
              .unionAll(supplier.select(F.concat(F.lit("Supplier#x"), "s_nationkey"))).distinct())
    wanted = wanted.where(F.trim("wanted").try_cast("bigint").isNull())
    names = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return resolved(wanted, "wanted", names).withColumnRenamed("id", "supplier_key")


@query("in_bbox", with_(POSITIONS) + """
SELECT event_id, lat BETWEEN 17.10 AND 17.75 AND lon BETWEEN 78.15 AND 78.75 AS inside FROM positions""")
def in_bbox(spark, d):
    return mapping.positions(spark, d).select("event_id", in_box(F.col("lat"), F.col("lon")).alias("inside"))


@query("nearest_zone", with_(POSITIONS, ZONES) + """
SELECT event_id, arg_min(zone_id, (power(latitude - lat, 2) + power((longitude - lon) * cos(radians(lat)), 2), zone_id)) AS zone_id
FROM (SELECT event_id, lat, lon, zone_id, latitude, longitude FROM positions, zones) GROUP BY event_id""")
def nearest_zone_query(spark, d):
    found = nearest(mapping.positions(spark, d), "lat", "lon", zone_table(spark), "zone_id", "latitude", "longitude")
    return found.select("event_id", big("zone_id").alias("zone_id"))


@query("nearest_customer", with_(POSITIONS) + """,
homes AS (SELECT c_custkey, CAST(17.0 AS DOUBLE) + (c_custkey * 6007 % 9973) / 9973 AS y,
                 CAST(78.0 AS DOUBLE) + power((c_custkey * 3571 % 9967) / 9967, 3) AS x FROM customer)
SELECT event_id, arg_min(c_custkey, (power(y - lat, 2) + power((x - lon) * cos(radians(lat)), 2), c_custkey)) AS c_custkey
FROM positions, homes GROUP BY event_id""")
def nearest_customer(spark, d):
    """A table of places that grows with the data and crowds in the west, not a list in the query."""
    key = F.col("c_custkey")
    homes = read(spark, d, "customer").select(
        "c_custkey", (F.lit(17.0) + (key * 6007 % 9973) / 9973).alias("y"),
        (F.lit(78.0) + F.pow((key * 3571 % 9967) / 9967, F.lit(3))).alias("x"))
    return nearest(mapping.positions(spark, d), "lat", "lon", homes, "c_custkey", "y", "x").select("event_id", "c_custkey")


@query("tariff_fare", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round_even((CAST(t.base AS DOUBLE) + t.per_km * l_quantity) * CAST(1.2 AS DOUBLE), 2) AS fare
FROM lineitem JOIN (VALUES (0, 30, 12), (1, 20, 8), (2, 50, 13), (3, 65, 16), (4, 90, 21)) t(v, base, per_km)
  ON l_suppkey % 5 = t.v""")
def tariff_fare(spark, d):
    vehicle = F.element_at(F.array(*[F.lit(v) for v in s.TARIFF]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        s.tariff_fare(vehicle, F.col("l_quantity"), F.lit(1.2)).alias("fare"))


@query("speed_band", """
SELECT event_id, CAST(CASE WHEN hour(ts) IN (8, 9, 10, 17, 18, 19, 20) THEN 16 WHEN hour(ts) BETWEEN 11 AND 16 THEN 22 ELSE 30 END AS DOUBLE) AS kmph
FROM events""")
def speed_band(spark, d):
    return read(spark, d, "events").select("event_id", s.speed_kmph(F.hour("ts")).alias("kmph"))

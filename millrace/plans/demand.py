"""Zone demand and supply in sliding windows, priced and smoothed (batch)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.pricing import LOOKBACK_STEPS, MULTIPLIER_CAP, priced, smooth_step
from millrace.functions.scalars import store_key
from millrace.operators.aggregates import newest_per_key
from millrace.operators.dedup import upsert
from millrace.operators.joins import with_newest, zero_filled
from millrace.operators.series import step_limited

# Fixed values.
LOWEST_MULTIPLIER = 1.0
STORE_TTL_DAYS = 7
UTILISATION_TARGET = 0.78
STORE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def sliding_demand_supply(events: DataFrame, size_seconds: int = 300, slide_seconds: int = 60,
                          dedup: bool = True) -> DataFrame:
    """Requests and distinct free / busy drivers per zone and sliding window.

    Events are first reduced to one row per (zone, slide, role, driver) and only
    those rows are copied into the ``size / slide`` windows they belong to, so
    the raw events are shuffled once (for the duplicates) and never multiplied.
    """
    if size_seconds % slide_seconds:
        raise ValueError("the window size must be a multiple of the slide")
    if dedup:
        events = events.dropDuplicates(["event_id", "event_time"])
    epoch = F.unix_timestamp("event_time")
    role = F.when(F.col("kind") == "request", "request").otherwise(F.coalesce("status", F.lit("other")))
    panes = (events.groupBy("zone_id", (epoch - F.pmod(epoch, F.lit(slide_seconds))).alias("_pane"),
                            role.alias("_role"), "driver_id")
             .agg(F.count(F.lit(1)).alias("_n")))
    start = F.explode(F.sequence(F.col("_pane") - (size_seconds - slide_seconds), F.col("_pane"), F.lit(slide_seconds)))
    per_driver = (panes.select("zone_id", start.alias("_start"), "_role", "driver_id", "_n")
                  .groupBy("zone_id", "_start", "_role", "driver_id").agg(F.sum("_n").alias("_n")))
    known = F.col("driver_id").isNotNull()
    return (per_driver.groupBy("zone_id", "_start").agg(
                F.coalesce(F.sum(F.when(F.col("_role") == "request", F.col("_n"))), F.lit(0)).alias("demand"),
                F.count_if((F.col("_role") == "AVAILABLE") & known).alias("drivers_available"),
                F.count_if((F.col("_role") == "ON_TRIP") & known).alias("drivers_on_trip"))
            .select("zone_id", F.timestamp_seconds("_start").alias("window_start"),
                    F.timestamp_seconds(F.col("_start") + size_seconds).alias("window_end"),
                    "demand", "drivers_available", "drivers_on_trip"))


def current_windows(windows: DataFrame) -> DataFrame:
    """Per zone the earliest window that ends at or after the newest window start.

    The newest windows have only just begun; the one picked here holds almost a
    full window of history.
    """
    newest = windows.agg(F.max("window_start").alias("r")).scalar()
    return newest_per_key(windows.where(F.col("window_end") >= newest), ["zone_id"], [F.asc("window_end")])


def current_zones(windows: DataFrame, zones: DataFrame, slide_seconds: int) -> DataFrame:
    """Current windows for every known zone; silent zones get zeros and the newest minute."""
    fallback = windows.agg((F.max("window_start") + F.make_dt_interval(secs=F.lit(slide_seconds))).alias("w")).scalar()
    rows = current_windows(windows).select("zone_id", "window_end", "demand",
                                           F.col("drivers_available").alias("supply"),
                                           F.col("drivers_on_trip").alias("on_trip"))
    out = zero_filled(zones.select("zone_id"), rows, "zone_id", {"demand": 0, "supply": 0, "on_trip": 0})
    # No window at all: nothing to report, not forty rows of zeros.
    return (out.withColumn("window_end", F.coalesce("window_end", fallback))
            .where(F.col("window_end").isNotNull()))


def price_windows(windows: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """Ratio, base, surcharge and capped multiplier per window, not smoothed."""
    rows = windows
    if weather is not None:
        hourly = weather.select(F.col("hour_ts").alias("_hour"), F.col("rain_mm").alias("rain_mm_h"), "temp_c")
        rows = (rows.withColumn("_hour", F.date_trunc("hour", "window_end"))
                .join(hourly, "_hour", "left").drop("_hour"))
    else:
        none = F.lit(None).cast("double")
        rows = rows.withColumns({"rain_mm_h": none, "temp_c": none})
    return rows.withColumns(priced(F.col("demand"), F.col("drivers_available"), F.col("rain_mm_h"), F.col("temp_c")))


def smooth_windows(priced_rows: DataFrame, slide_seconds: int = 60, key: str = "zone_id",
                   time: str = "window_end", target: str = "surge_multiplier",
                   name: str = "smoothed") -> DataFrame:
    """Multipliers that move at most one step from the one stored before.

    Chunks of 1440 steps (a day of minutes) nearly always settle.
    """
    return step_limited(priced_rows, key, time, target, name, smooth_step,
                        lookback_seconds=LOOKBACK_STEPS * slide_seconds,
                        low=LOWEST_MULTIPLIER, high=MULTIPLIER_CAP, chunk_seconds=1440 * slide_seconds)


def with_latest_weather(rows: DataFrame, readings: DataFrame) -> DataFrame:
    return with_newest(rows, readings, "event_time", ["rain_mm_h", "temp_c"])


def merge_store(store: DataFrame, rows: DataFrame, ttl_days: int = STORE_TTL_DAYS,
                now: Column | None = None) -> DataFrame:
    """Upsert by zone and minute; rows older than ``ttl_days`` disappear.

    Both sides have zone_id, window_end and value columns; the store has one row per key.  ``now`` defaults to
    the newest minute of the merged rows.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("row_key", store_key(F.col("zone_id"), F.col("window_end")))

    merged = upsert(keyed(store), keyed(rows), "row_key", "window_end")
    if now is None:
        now = F.greatest(*[df.agg(F.max("window_end").alias("m")).scalar() for df in (store, rows)])
    return merged.where(F.col("window_end") > now - F.make_dt_interval(days=F.lit(ttl_days)))


def history(store: DataFrame, zone_id: int, minutes: int, now: Column | None = None) -> DataFrame:
    """One zone's rows of the last ``minutes``, oldest first."""
    if now is None:
        now = store.agg(F.max("window_end").alias("m")).scalar()
    since = now - F.make_dt_interval(mins=F.lit(minutes))
    return store.where((F.col("zone_id") == zone_id) & (F.col("window_end") >= since)).orderBy("window_end")


def latest_rows(store: DataFrame) -> DataFrame:
    return newest_per_key(store, ["zone_id"], [F.desc("window_end")])


def fleet_utilisation(windows: DataFrame, date: str | None = None, zone_id: int | None = None) -> DataFrame:
    """on trip / (free + on trip) over the chosen windows; no row when nobody was online."""
    rows = windows
    if date is not None:
        rows = rows.where(F.to_date("window_end") == F.lit(date).cast("date"))
    if zone_id is not None:
        rows = rows.where(F.col("zone_id") == zone_id)
    out = rows.agg(F.sum("drivers_on_trip").alias("_busy"),
                   F.sum(F.col("drivers_available") + F.col("drivers_on_trip")).alias("_online"),
                   F.count(F.lit(1)).alias("windows_observed")).where(F.col("_online") > 0)
    share = F.col("_busy") / F.col("_online")
    return out.select(F.bround(share, 4).alias("utilisation"),
                      (share >= UTILISATION_TARGET).alias("target_met"), "windows_observed")


def hourly_surge(priced_rows: DataFrame) -> DataFrame:
    """Mean demand, supply and multiplier and the top multiplier per zone and hour.

    Multipliers are averaged as decimals, so the mean does not depend on row order.
    """
    multiplier = F.col("surge_multiplier").cast("decimal(18,2)")
    return (priced_rows.groupBy("zone_id", F.date_trunc("hour", "window_end").alias("hour_ts"))
            .agg((F.sum("demand") / F.count("demand")).alias("avg_demand"),
                 (F.sum("drivers_available") / F.count("drivers_available")).alias("avg_supply"),
                 (F.sum(multiplier).cast("double") / F.count(multiplier)).alias("avg_surge"),
                 F.max("surge_multiplier").alias("max_surge")))


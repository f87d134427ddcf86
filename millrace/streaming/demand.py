"""The surge pipeline: windowed demand in, priced and smoothed zone rows out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.geo import zone_table
from millrace.functions.pricing import LOOKBACK_STEPS, priced
from millrace.operators.aggregates import newest_per_key
from millrace.operators.joins import with_newest
from millrace.plans.demand import STORE_TIME_FORMAT, STORE_TTL_DAYS, current_zones
from millrace.sinks.streams import BatchWriter, fan_out, start
from millrace.sources.batch import parquet_or_empty
from millrace.streaming.windows import sliding_demand_supply

STORE = ("zone_id int, window_end timestamp, surge_multiplier double, demand bigint, supply bigint, on_trip bigint, "
         "ratio double, rain_mm_h double, temp_c double, day date, batch_id bigint")

Weather = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class SurgeJob:
    """Where the job keeps its keyed store and where readings come from.

    ``weather`` returns readings (event_time, rain_mm_h, temp_c); the newest one
    counts.  Without it, or without readings, no surcharge applies.
    """

    store: str
    weather: Weather | None = None
    slide_seconds: int = 60
    zones: Callable[[SparkSession], DataFrame] = zone_table


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Stored rows, the newest batch winning where a minute was written twice."""
    return newest_per_key(parquet_or_empty(spark, path, STORE), ["zone_id", "window_end"], [F.desc("batch_id")])


def with_previous(rows: DataFrame, store: DataFrame, slide_seconds: int) -> DataFrame:
    """Last stored multiplier strictly before each row's minute, at most ten minutes back.

    Only earlier minutes are read, so a replayed batch computes the same values.
    The store is cut to the days and minutes the batch can need before the join.
    """
    look = F.make_dt_interval(secs=F.lit(LOOKBACK_STEPS * slide_seconds))
    oldest = rows.agg((F.min("window_end") - look).alias("t")).scalar()
    recent = (store.where((F.col("day") >= F.to_date(oldest)) & (F.col("window_end") >= oldest))
              .select("zone_id", F.col("window_end").alias("_at"), F.col("surge_multiplier").alias("_multiplier"), "batch_id"))
    near = (rows.select("zone_id", "window_end").join(recent, "zone_id")
            .where((F.col("_at") < F.col("window_end")) & (F.col("_at") >= F.col("window_end") - look)))
    last = newest_per_key(near, ["zone_id"], [F.desc("_at"), F.desc("batch_id")])
    return rows.join(last.select("zone_id", F.col("_multiplier").alias("previous")), "zone_id", "left")


def priced_batch(windows: DataFrame, job: SurgeJob, batch_id: int) -> DataFrame:
    """One priced row for every zone from the windows a batch has touched."""
    spark = windows.sparkSession
    rows = current_zones(windows, job.zones(spark), job.slide_seconds)
    if job.weather is not None:
        rows = with_newest(rows, job.weather(spark), "event_time", ["rain_mm_h", "temp_c"])
    else:
        none = F.lit(None).cast("double")
        rows = rows.withColumns({"rain_mm_h": none, "temp_c": none})
    rows = with_previous(rows, parquet_or_empty(spark, job.store, STORE), job.slide_seconds)
    prices = priced(F.col("demand"), F.col("supply"), F.col("rain_mm_h"), F.col("temp_c"), F.col("previous"))
    out = rows.withColumns({k: prices[k] for k in ("ratio", "surge_multiplier")})
    return out.select("zone_id", "window_end", "demand", "supply", "on_trip", "ratio", "surge_multiplier",
                      "rain_mm_h", "temp_c", F.current_timestamp().alias("processed_at"),
                      F.lit(batch_id).cast("bigint").alias("batch_id"))


def store_batch(path: str) -> BatchWriter:
    """Put a batch into the keyed store.  Its folders depend on day and batch only and a
    replay overwrites just them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select("zone_id", "window_end", "surge_multiplier", "demand", "supply", "on_trip", "ratio", "rain_mm_h",
                      "temp_c", F.to_date("window_end").alias("day"), F.lit(batch_id).cast("bigint").alias("batch_id"))
         .hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").parquet(path))
    return write


def compact_store(spark: SparkSession, path: str, target: str, ttl_days: int = STORE_TTL_DAYS) -> None:
    """Write the live rows of a store to a new folder: one row per key, none older than the TTL."""
    rows = read_store(spark, path)
    newest = rows.agg(F.max("window_end").alias("m")).scalar()
    live = rows.where(F.col("window_end") > newest - F.make_dt_interval(days=F.lit(ttl_days)))
    live.hint("rebalance", "day").write.mode("overwrite").partitionBy("day", "batch_id").parquet(target)


def published(rows: DataFrame) -> DataFrame:
    """Times as text, the shape that consumers of the output read."""
    return rows.withColumns({c: F.date_format(c, STORE_TIME_FORMAT) for c in ("window_end", "processed_at")})


def surge_writer(job: SurgeJob, *sinks: BatchWriter) -> BatchWriter:
    """Price each batch once, then store it and hand it to the other sinks in order."""
    def as_text(sink: BatchWriter) -> BatchWriter:
        return lambda batch, batch_id: sink(published(batch), batch_id)

    return fan_out(store_batch(job.store), *[as_text(s) for s in sinks],
                   prepare=lambda batch, batch_id: priced_batch(batch, job, batch_id))


def surge_query(requests: DataFrame, pings: DataFrame, job: SurgeJob, *sinks: BatchWriter, checkpoint: str,
                interval: str | None = "60 seconds", available_now: bool = False) -> StreamingQuery:
    windows = sliding_demand_supply(requests, pings, slide=f"{job.slide_seconds} seconds")
    return start(windows, surge_writer(job, *sinks), mode="update", checkpoint=checkpoint, interval=interval,
                 available_now=available_now)

"""Landing, silver and gold tables fed by streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.quality import apply_rules, lake_ping_rules, lake_trip_rules
from millrace.plans import trips as kpis
from millrace.session import STATIC_CONF, delete_folder, make_folder, settings
from millrace.sinks.streams import parquet_batch, start
from millrace.sources.stream import parquet_files
from millrace.tables import DRIVER_PINGS, TRIPS

# As many keys as rows: they are kept on disk, whatever the session's own choice, and many small
# stores do not each reserve disk that they do not fill.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
KEYS = {STATE_STORE: STATIC_CONF[STATE_STORE], "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
# Of the lake's writers.  Times and numbers written as text have few different bytes: with wide
# pages and a thorough search zstd takes an eighth less for them, at little more time.
PARQUET = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(4 << 20), "parquet.page.row.count.limit": "200000"}


@dataclass(frozen=True)
class Lake:
    landing: str
    tables: str
    checkpoints: str
    # How far apart copies of a row may arrive.  Keys are forgotten after that,
    # so the deduplication state stays bounded.
    watermark: str = "1 day"
    # Of the files of every layer: their ids are long texts, which zstd halves against snappy.
    compression: str = "zstd"

    def path(self, table: str) -> str:
        return f"{self.tables}/{table}"

    def marks(self, table: str) -> str:
        return f"{self.checkpoints}/marks_{table}"


def appended(spark: SparkSession, lake: Lake, rows: DataFrame, table: str) -> StreamingQuery:
    # A stream's sink takes no settings of Parquet from its options, but those of the session.
    with settings(spark, PARQUET):
        return start(rows, "parquet", available_now=True, checkpoint=f"{lake.checkpoints}/{table}",
                     options={"path": lake.path(table), "compression": lake.compression})


def bronze(spark: SparkSession, lake: Lake, folder: str, schema: str) -> StreamingQuery:
    """New Parquet files as they are."""
    return appended(spark, lake, parquet_files(spark, f"{lake.landing}/{folder}", schema), f"bronze_{folder}")


def valid_trips(rows: DataFrame) -> DataFrame:
    return apply_rules(rows, lake_trip_rules())


def valid_pings(rows: DataFrame) -> DataFrame:
    return apply_rules(rows.withColumn("ts", F.try_to_timestamp("event_time")), lake_ping_rules())


@dataclass(frozen=True)
class Cleaned:
    """A silver table: the valid rows of a bronze one, one of each key."""

    name: str
    schema: str
    valid: Callable[[DataFrame], DataFrame]
    key: str
    time: str


SILVER = (Cleaned("trips", TRIPS, valid_trips, "trip_id", "request_time"),
          Cleaned("pings", DRIVER_PINGS, valid_pings, "event_id", "ts"))

MARKS = "_file bigint, _block bigint, _bits binary"
# Rows of a file that one row of marks covers; Spark's bitmaps cover eight times as many.
BLOCK, BITMAP = 4096, 32768


def placed(spark: SparkSession, lake: Lake, table: Cleaned) -> DataFrame:
    """The valid rows of a bronze table as a stream, each with its file (a hash of the path) and its number there."""
    rows = parquet_files(spark, lake.path(f"bronze_{table.name}"), table.schema)
    return table.valid(rows.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")))


def first_rows(rows: DataFrame, key: str, time: str, watermark: str) -> DataFrame:
    """The place of one row of each key.

    The rows themselves stay where they are: shuffled are 96 bits of the key's
    SHA-256, the time and the place, and the first two are the state.  Of 10 ** 9
    keys, some two share their bits with a probability of 6e-12.
    """
    digest = F.substring(F.unhex(F.sha2(key, 256)), 1, 12).alias("_key")
    return (rows.select(digest, "_file", "_row", time).withWatermark(time, watermark)
            .dropDuplicatesWithinWatermark(["_key"]).select("_file", "_row"))


def marks(places: DataFrame) -> DataFrame:
    """Places as bitmaps of their files' rows."""
    # Dealt before they are gathered: a bitmap of a few of a block's places is as long as one of all.
    bitmaps = (places.select("_file", F.shiftright("_row", 15).alias("_wide"), (F.col("_row") % BITMAP).alias("_at"))
               .repartition("_file", "_wide").groupBy("_file", "_wide").agg(F.bitmap_construct_agg("_at").alias("_all")))
    parts = F.sequence(F.lit(0), F.lit(BITMAP // BLOCK - 1))
    return bitmaps.withColumn("_part", F.explode(parts)).select(
        "_file", (F.col("_wide") * (BITMAP // BLOCK) + F.col("_part")).alias("_block"),
        F.substring("_all", F.col("_part") * (BLOCK // 8) + 1, F.lit(BLOCK // 8)).alias("_bits"))


def marked(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows that are marked.  The marks are broadcast: a bit for each row of the files they cover."""
    at = (F.col("_row") % BLOCK).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("_block", F.shiftright("_row", 12)).join(F.broadcast(bits), ["_file", "_block"])
            .where(F.getbit(byte, at % 8) == 1).drop("_file", "_row", "_block", "_bits"))


def mark_first(spark: SparkSession, lake: Lake, table: Cleaned) -> StreamingQuery:
    """Mark the rows of new bronze files that silver takes."""
    def write(places: DataFrame, batch_id: int) -> None:
        parquet_batch(lake.marks(table.name))(marks(places), batch_id)
    with settings(spark, KEYS):
        return start(first_rows(placed(spark, lake, table), table.key, table.time, lake.watermark), write,
                     available_now=True, checkpoint=f"{lake.checkpoints}/first_{table.name}")


def take_marked(spark: SparkSession, lake: Lake, table: Cleaned) -> StreamingQuery:
    """Copy the marked rows of new bronze files to silver, every file in one piece."""
    make_folder(spark, lake.marks(table.name))
    bits = spark.read.schema(MARKS).parquet(lake.marks(table.name)).select("_file", "_block", "_bits")
    return appended(spark, lake, marked(placed(spark, lake, table), bits), f"silver_{table.name}")


def silver(spark: SparkSession, lake: Lake) -> list[StreamingQuery]:
    """Valid rows, one of each key, in two passes over new bronze files: no row is shuffled, only its place is.

    Both passes must find the same files, so bronze is not to be fed meanwhile.
    """
    for query in [mark_first(spark, lake, table) for table in SILVER]:
        query.awaitTermination()
    return [take_marked(spark, lake, table) for table in SILVER]


def gold(spark: SparkSession, lake: Lake, source: str | None = None) -> dict[str, DataFrame]:
    """KPI tables over the silver layer; ``source`` keeps one kind of pings."""
    trips = spark.read.schema(TRIPS).parquet(lake.path("silver_trips"))
    pings = spark.read.parquet(lake.path("silver_pings"))
    if source is not None:
        pings = pings.where(F.col("source") == source)
    return {"zone_hourly_kpis": kpis.zone_hour_kpis_lake(trips),
            "revenue_per_km": kpis.revenue_per_km(trips),
            "driver_daily_utilisation": kpis.driver_daily_utilisation(
                pings.withColumn("event_time", F.col("ts")))}


def zone_minute_surge(bronze_surge: DataFrame) -> DataFrame:
    return bronze_surge.select("zone_id", "window_end", "demand", "supply", "on_trip", "ratio", "surge_multiplier",
                               "rain_mm_h", "temp_c")


def run(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """One pass over everything that has landed since the last one."""
    for query in [bronze(spark, lake, "trips", TRIPS), bronze(spark, lake, "pings", DRIVER_PINGS)]:
        query.awaitTermination()
    for query in silver(spark, lake):
        query.awaitTermination()
    for table in SILVER:  # their rows are in silver now
        delete_folder(spark, lake.marks(table.name))
    return gold(spark, lake)

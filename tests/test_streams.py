"""Streams on files: each gives what its batch twin gives, also after a restart."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from support import rows
from millrace.functions.geo import zone_table
from millrace.operators.quality import batch_continuity, delivery_audit
from millrace.plans import demand, visits
from millrace.sinks import streams as sinks
from millrace.sources import stream as sources
from millrace.streaming import alerts, archive, medallion, running, smoothing, windows
from millrace.streaming.demand import SurgeJob, compact_store, published, read_store, surge_query
from millrace.tables import (CARD_TRANSACTIONS, CLICKSTREAM, CSV_PAYMENTS, CSV_TRANSACTIONS, DEPARTMENT_EVENTS,
                             DRIVER_PINGS, TRIP_REQUESTS, TRIPS, WEATHER)


def land(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def run(df, sink="memory", **kwargs):
    query = sinks.start(df, sink, available_now=True, **kwargs)
    query.awaitTermination()
    return query


@pytest.fixture
def out(spark):
    """Run a stream into a memory table and return its rows."""
    def go(df, mode):
        name = f"t{random.randrange(10**9)}"
        run(df, name=name, mode=mode)
        return rows(spark.table(name))
    return go


# ---- stateless and running totals ------------------------------------------

@pytest.fixture
def csv_stream(spark, tmp_path):
    head = "TransactionID,EmployeeID,Department,Amount"
    land(tmp_path / "in", "a.csv", [head, "T1,E1,IT,8000", "T2,E2,HR,3000", "T3,E1,IT,4500"])
    land(tmp_path / "in", "b.csv", [head, "T4,E3,IT,12000", "T5,E4,HR,5000"])
    return sources.csv_files(spark, str(tmp_path / "in"), CSV_TRANSACTIONS, files_per_trigger=1)


def test_running_totals_equal_batch(spark, csv_stream, tmp_path, out):
    batch = spark.read.schema(CSV_TRANSACTIONS).csv(str(tmp_path / "in"), header=True)
    streamed = out(running.department_totals(csv_stream, "Department", "Amount"), "complete")
    assert streamed == rows(running.department_totals(batch, "Department", "Amount"))
    assert streamed == [("HR", 2, 8000.0, 4000.0), ("IT", 3, 24500.0, 8166.67)]


def test_console_sink_and_update_mode(csv_stream):
    totals = running.department_totals(csv_stream, "Department", "Amount")
    sinks.console(totals, "complete", available_now=True).awaitTermination()
    sinks.console(totals, "update", available_now=True, rows=5, truncate=True).awaitTermination()


def test_fixed_interval_trigger(csv_stream):
    query = sinks.start(csv_stream, "memory", name="ticking", interval="1 second")
    query.processAllAvailable()
    query.stop()
    assert csv_stream.sparkSession.table("ticking").count() == 5


@pytest.fixture
def events(spark):
    return spark.createDataFrame([("1", "E1", "IT", 12000.0), ("2", "E2", "IT", 6000.0), ("3", "E3", "HR", 10.0),
                                  ("4", None, "HR", 20000.0)], DEPARTMENT_EVENTS)


def messages_of(df):
    return df.coalesce(1).select(F.to_json(F.struct("*")).alias("value"), F.lit(0).alias("partition"),
                     F.monotonically_increasing_id().alias("offset"))


def topic(df, base, name):
    """Write a frame as the messages of a file-backed topic."""
    messages_of(df).write.mode("append").json(f"{base}/{name}")


def test_risk_and_alerts(spark, events, tmp_path, out):
    topic(events, tmp_path, "department")
    reader = sources.file_topics(spark, str(tmp_path))
    stream = sources.parsed(reader("department"), DEPARTMENT_EVENTS)
    assert out(running.risk_totals(stream), "complete") == [
        ("HIGH_RISK", 2, 32000.0, 16000.0), ("NORMAL", 1, 10.0, 10.0), ("SUSPICIOUS", 1, 6000.0, 6000.0)]
    sorted_totals = running.department_risk_totals(stream)
    assert len(out(sorted_totals, "complete")) == 4
    got = dict((m, level) for level, m in out(alerts.threshold_alerts(stream), "append"))
    assert got == {"🚨 HIGH-RISK ALERT | Transaction: 1 | Employee: E1 | Department: IT | Amount: ₹12000.0": "HIGH_RISK",
                   None: "HIGH_RISK"}  # an unknown employee makes the message null
    assert rows(alerts.threshold_alerts(events)) == out(alerts.threshold_alerts(stream), "append")


def test_payment_category(spark, tmp_path, out):
    land(tmp_path / "p", "a.csv", ["payment_id,visit_id,payment_date,payment_amount,payment_method",
                                   "P1,V1,2026-01-01,2000,card", "P2,V2,2026-01-01,10,cash"])
    stream = sources.csv_files(spark, str(tmp_path / "p"), CSV_PAYMENTS)
    got = out(alerts.with_payment_category(stream).select("payment_id", "payment_category"), "append")
    assert got == [("P1", "HIGH"), ("P2", "NORMAL")]


def test_card_alerts(spark, tmp_path, out):
    cards = spark.createDataFrame([("a", "x", 100000.0, "m", "IN", "2026-01-01T00:00:00", False), ("b", "x", 5.0, "m", "US", "bad", True),
                                   ("c", "x", 5.0, "m", "IN", None, None), ("d", "x", None, "m", "US", None, True)], CARD_TRANSACTIONS)
    topic(cards, tmp_path, "cards")
    stream = sources.parsed(sources.file_topics(spark, str(tmp_path))("cards"), CARD_TRANSACTIONS)
    timed = stream.withColumn("event_timestamp", F.try_to_timestamp("event_time"))
    got = out(alerts.card_alerts(timed).select("transaction_id", "alert_reason"), "append")
    assert got == [("a", "HIGH_VALUE"), ("b", "INTERNATIONAL")]


def test_unreadable_messages_are_dropped(spark, tmp_path, out):
    good = {"event_id": "1", "user_id": "u", "event_type": "view", "page": "/", "event_time": "2026-01-01T00:00:00Z"}
    land(tmp_path / "clicks", "a.json", [{"value": json.dumps(good), "partition": 0, "offset": 0},
                                         {"value": "not json", "partition": 0, "offset": 1}])
    stream = sources.parsed(sources.file_topics(spark, str(tmp_path))("clicks"), CLICKSTREAM)
    assert [r[0] for r in out(windows.usable_events(stream), "append")] == ["1"]


# ---- event-time windows ----------------------------------------------------

def test_tumbling_counts_equal_batch_and_late_rows_are_dropped(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)

    def event(i, seconds, kind="view"):
        return {"event_id": str(i), "user_id": "u", "event_type": kind, "page": "/",
                "event_time": (start + dt.timedelta(seconds=seconds)).isoformat() + "Z"}

    folder, check = tmp_path / "in", str(tmp_path / "check")
    folder.mkdir()
    stream = sources.json_files(spark, str(folder), CLICKSTREAM, files_per_trigger=1)
    counts = windows.tumbling_counts(stream)
    target = str(tmp_path / "out")

    def go():
        return run(counts, "parquet", checkpoint=check, options={"path": target})

    land(folder, "a.json", [event(i, i * 7, "view" if i % 2 else "click") for i in range(60)])
    land(folder, "b.json", [event(100, 1000)])  # moves the watermark past the first windows
    go()
    land(folder, "c.json", [event(101, 1)])     # sixteen minutes late
    land(folder, "d.json", [event(102, 2000)])
    query = go()                                # restart from the checkpoint
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    batch = spark.read.schema(CLICKSTREAM).json([str(folder / "a.json"), str(folder / "b.json")])
    assert rows(spark.read.parquet(target)) == rows(windows.tumbling_counts(batch))


def test_totals_on_arrival(spark, csv_stream):
    named = csv_stream.select(F.col("Department").alias("department"), F.col("Amount").alias("amount"))
    run(windows.tumbling_totals_on_arrival(named), name="arrival", mode="update")
    total = spark.table("arrival").groupBy("department").agg(F.max("totalAmount").alias("m"))
    assert total.count() == 2


def test_duplicates_within_the_watermark(spark, tmp_path, out):
    land(tmp_path / "d", "a.json", [{"event_id": "1", "user_id": "u", "event_type": "v", "page": "/", "event_time": t}
                                    for t in ("2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z", "2026-01-01T00:01:00Z")])
    stream = sources.json_files(spark, str(tmp_path / "d"), CLICKSTREAM)
    assert len(out(windows.deduplicated(stream).select("event_id", "event_time"), "append")) == 2
    assert len(out(windows.deduplicated(stream, by_id_only=True).select("event_id"), "append")) == 1


# ---- the surge pipeline ----------------------------------------------------

def iso(minute, second=0):
    return f"2026-10-12T12:{minute:02d}:{second:02d}Z"


def surge_input(tmp_path):
    requests, pings = [], []
    for i in range(30):
        requests.append({"event_id": f"r1-{i}", "event_time": iso(56, i), "zone_id": 1})
    for i in range(10):
        requests.append({"event_id": f"r2-{i}", "event_time": iso(57, i), "zone_id": 2})
    requests += requests[30:35]                                         # five copies
    requests.append({"event_id": "lost", "event_time": "bad", "zone_id": 1})
    pings += [{"event_id": f"p1-{i}", "event_time": iso(56, i), "driver_id": f"a{i % 2}", "zone_id": 1, "status": "available"} for i in range(4)]
    pings += [{"event_id": f"p1b-{i}", "event_time": iso(57, i), "driver_id": f"b{i}", "zone_id": 1, "status": "ON_TRIP"} for i in range(3)]
    pings += [{"event_id": f"p2-{i}", "event_time": iso(57, i), "driver_id": f"c{i}", "zone_id": 2, "status": "AVAILABLE"} for i in range(10)]
    pings += [{"event_id": f"p3-{i}", "event_time": iso(58, i), "driver_id": f"d{i}", "zone_id": 3, "status": "AVAILABLE"} for i in range(5)]
    pings.append({"event_id": "now", "event_time": iso(58, 59), "driver_id": "z", "zone_id": 40, "status": "OFFLINE"})
    land(tmp_path / "req", "a.json", requests)
    land(tmp_path / "png", "a.json", pings)
    land(tmp_path / "weather", "a.json", [{"event_time": iso(0), "rain_mm_h": 0.0, "temperature_c": 20.0},
                                          {"event_time": iso(50), "rain_mm_h": 3.0, "temperature_c": 20.0}])


def weather_source(tmp_path):
    def read(spark):
        return (spark.read.schema(WEATHER).json(str(tmp_path / "weather"))
                .select("event_time", "rain_mm_h", F.col("temperature_c").alias("temp_c")))
    return read


def start_surge(spark, tmp_path, job, *sinks_):
    req = sources.json_files(spark, str(tmp_path / "req"), TRIP_REQUESTS)
    png = sources.json_files(spark, str(tmp_path / "png"), DRIVER_PINGS)
    query = surge_query(req, png, job, *sinks_, checkpoint=str(tmp_path / "check"), available_now=True)
    query.awaitTermination()


def test_surge_pipeline(spark, tmp_path):
    surge_input(tmp_path)
    store, bronze, topic_dir = (str(tmp_path / n) for n in ("store", "bronze", "messages"))
    job = SurgeJob(store, weather_source(tmp_path))
    writers = (sinks.json_batch(topic_dir, "zone_id"), sinks.parquet_batch(bronze))
    start_surge(spark, tmp_path, job, *writers)
    first = {r["zone_id"]: r for r in spark.read.parquet(bronze).collect()}
    assert len(first) == 40
    z = first[1]
    assert (z["demand"], z["supply"], z["on_trip"], z["ratio"], z["surge_multiplier"]) == (30, 2, 3, 15.0, 2.7)
    assert (first[2]["demand"], first[2]["supply"], first[2]["surge_multiplier"]) == (10, 10, 1.4)
    assert (first[3]["demand"], first[3]["supply"], first[3]["surge_multiplier"]) == (0, 5, 1.2)
    assert (first[9]["demand"], first[9]["supply"], first[9]["ratio"]) == (0, 0, 0.0)
    assert first[1]["window_end"] == iso(58) and first[9]["window_end"] == iso(59)
    message = json.loads(spark.read.json(topic_dir).where("key = '1'").first()["value"])
    assert message["surge_multiplier"] == 2.7 and message["window_end"] == iso(58)

    # A second batch after a restart: the demand is gone and the multiplier steps down by 0.3.
    land(tmp_path / "png", "b.json", [{"event_id": f"q{i}", "event_time": "2026-10-12T13:04:10Z", "driver_id": f"q{i}", "zone_id": 1,
                                       "status": "AVAILABLE"} for i in range(3)])
    start_surge(spark, tmp_path, job, *writers)
    second = {r["zone_id"]: r for r in read_store(spark, store).where("batch_id > 0").collect()}
    assert second[1]["demand"] == 0 and second[1]["surge_multiplier"] == 2.4
    # Batches that only move the watermark write nothing, so ids may skip; sizes must hold.
    sizes = batch_continuity(spark.read.parquet(bronze), "batch_id", 40)
    assert sizes.count() == 2 and sizes.where("wrong_size").count() == 0

    compact_store(spark, store, str(tmp_path / "compact"))
    assert read_store(spark, str(tmp_path / "compact")).count() == read_store(spark, store).count()


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    surge_input(tmp_path)
    store, bronze = str(tmp_path / "store"), str(tmp_path / "bronze")
    from millrace.streaming.demand import surge_writer
    write = surge_writer(SurgeJob(store, None), sinks.parquet_batch(bronze))
    batch = demand.sliding_demand_supply(spark.createDataFrame(
        [("a", dt.datetime(2026, 10, 12, 12, 0, 1), 1, "request", None, None)],
        "event_id string, event_time timestamp, zone_id int, kind string, driver_id string, status string"))
    for batch_id in (0, 1, 1):
        write(batch, batch_id)
    assert spark.read.parquet(bronze).count() == 80
    first = rows(read_store(spark, store).where("zone_id = 1").select("window_end", "surge_multiplier"))
    write(batch, 1)
    assert rows(read_store(spark, store).where("zone_id = 1").select("window_end", "surge_multiplier")) == first
    assert spark.read.parquet(bronze).where("rain_mm_h IS NOT NULL").count() == 0
    write(batch.limit(0), 2)
    assert spark.read.parquet(bronze).count() == 80


def test_stream_windows_equal_exact_batch(spark, tmp_path):
    surge_input(tmp_path)
    req = sources.json_files(spark, str(tmp_path / "req"), TRIP_REQUESTS)
    png = sources.json_files(spark, str(tmp_path / "png"), DRIVER_PINGS)
    run(windows.sliding_demand_supply(req, png), name="live_windows", mode="complete")
    from millrace.operators.dedup import union_events
    batch = demand.sliding_demand_supply(union_events(
        spark.read.schema(TRIP_REQUESTS).json(str(tmp_path / "req")), spark.read.schema(DRIVER_PINGS).json(str(tmp_path / "png"))))
    columns = ["zone_id", "window_start", "window_end", "demand", "drivers_available", "drivers_on_trip"]
    assert rows(spark.table("live_windows").select(columns)) == rows(batch.select(columns))


def test_all_zones_need_at_least_one_window(spark):
    none = spark.createDataFrame([], "zone_id int, window_start timestamp, window_end timestamp, demand bigint, "
                                     "drivers_available bigint, drivers_on_trip bigint")
    assert demand.current_zones(none, zone_table(spark), 60).count() == 0


def test_output_times_are_text(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1))], "window_end timestamp, processed_at timestamp")
    assert published(df).first()["window_end"] == "2026-01-01T00:00:00Z"


# ---- stateful smoothing ----------------------------------------------------

@pytest.mark.parametrize("target,previous,result", [(2.5, 1.0, 1.3), (1.0, 2.0, 1.7), (3.5, None, 3.0), (2.0, 1.9, 2.0)])
def test_smoothing_rule(target, previous, result):
    assert smoothing.smooth(target, previous) == result


def test_stateful_smoothing_equals_batch_across_restarts(spark, tmp_path):
    random.seed(2)
    start, data = dt.datetime(2026, 1, 1), []
    for zone in (1, 2):
        minute = 0
        for _ in range(60):
            minute += random.choice([1, 1, 1, 14])
            data.append((zone, start + dt.timedelta(minutes=minute), random.choice([1.0, 1.5, 2.5, 3.4])))
    schema = "zone_id int, window_end timestamp, surge_multiplier double"
    data.sort(key=lambda r: r[1])
    folder, target, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([], schema).write.parquet(folder)
    stream = sources.parquet_files(spark, folder, schema)
    for part in (data[:40], data[40:41], data[41:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        run(smoothing.smoothed(stream), "parquet", checkpoint=check, options={"path": target})
    batch = demand.smooth_windows(spark.createDataFrame(data, schema))
    assert rows(spark.read.parquet(target)) == rows(batch.select("zone_id", "window_end", "surge_multiplier", "smoothed"))


# ---- archives --------------------------------------------------------------

def test_raw_text_archive(spark, events, tmp_path):
    topic(events, tmp_path / "topics", "bank")
    reader = sources.file_topics(spark, str(tmp_path / "topics"))
    archive.raw_text(reader("bank"), str(tmp_path / "text"), str(tmp_path / "check"), available_now=True).awaitTermination()
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "text")).collect()]
    assert len(lines) == 4 and {x["transactionId"] for x in lines} == {"1", "2", "3", "4"}


def test_topics_are_archived_with_offsets(spark, tmp_path):
    requests = spark.range(20).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit(iso(1)).alias("event_time"),
                                      F.lit(1).alias("zone_id"))
    topic(requests, tmp_path / "topics", "trip_requests")
    reader = sources.file_topics(spark, str(tmp_path / "topics"))
    for query in archive.topics(reader, str(tmp_path / "raw"), str(tmp_path / "check"),
                                {"trip_requests": TRIP_REQUESTS}, available_now=True).values():
        query.awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "raw" / "trip_requests"))
    assert {"partition", "offset", "event_id"} <= set(landed.columns)
    assert delivery_audit(landed).first()["exactly_once"] is True


def test_visits_land_and_are_counted(spark, tmp_path):
    v = spark.range(9).select(F.concat(F.lit("u"), F.col("id") % 2).alias("visitor_id"), F.lit("n").alias("name"),
                              F.when(F.col("id") > 2, "/a").otherwise("/b").alias("page"), F.lit("view").alias("action"),
                              F.lit("t").alias("timestamp"))
    topic(v, tmp_path / "topics", "visits")
    archive.visits(sources.file_topics(spark, str(tmp_path / "topics")), "visits", str(tmp_path / "table"), str(tmp_path / "check"),
                   available_now=True).awaitTermination()
    assert visits.visit_stats(spark.read.parquet(str(tmp_path / "table"))).first()[0:5] == (9, 2, 2, "/a", 6)


def test_medallion(spark, tmp_path):
    from test_jobs import trip
    lake = medallion.Lake(str(tmp_path / "landing"), str(tmp_path / "tables"), str(tmp_path / "check"))
    trips = [trip(1), trip(1), trip(2, fare="-1.00"), trip(3, zone=None), trip(4, wait=-2), trip(5, ride=-5), trip(6)]
    spark.createDataFrame(trips, TRIPS).write.mode("append").parquet(f"{lake.landing}/trips")
    ping = lambda i, lat, status: (f"p{i}", iso(i), "D1", 1, lat, 78.4, status, "gps_simulator")
    spark.createDataFrame([ping(1, 17.4, "ON_TRIP"), ping(1, 17.4, "ON_TRIP"), ping(2, 10.0, "ON_TRIP"), ping(3, 17.4, "AVAILABLE")],
                          DRIVER_PINGS).write.mode("append").parquet(f"{lake.landing}/pings")
    gold = medallion.run(spark, lake)
    assert rows(gold["zone_hourly_kpis"].select("pickup_zone_id", "requests", "revenue_inr")) == [(10, 2, 200.0)]
    assert rows(gold["driver_daily_utilisation"].select("driver_id", "utilisation", "pings")) == [("D1", 0.5, 2)]
    # only new files are read the next time
    spark.createDataFrame([trip(7)], TRIPS).write.mode("append").parquet(f"{lake.landing}/trips")
    assert medallion.run(spark, lake)["zone_hourly_kpis"].first()["requests"] == 3
    assert medallion.gold(spark, lake, "other")["driver_daily_utilisation"].count() == 0
    surge = spark.createDataFrame([(1, "t", 1, 1, 1, 1.0, 1.0, 0.0, 20.0, 5)], "zone_id int, window_end string, demand int, supply int, "
                                  "on_trip int, ratio double, surge_multiplier double, rain_mm_h double, temp_c double, batch_id int")
    assert "batch_id" not in medallion.zone_minute_surge(surge).columns


def test_the_lake_is_written_small(spark, tmp_path):
    from test_jobs import trip
    lake = medallion.Lake(str(tmp_path / "landing"), str(tmp_path / "tables"), str(tmp_path / "check"))
    spark.createDataFrame([trip(1), trip(1), trip(6)], TRIPS).write.parquet(f"{lake.landing}/trips")
    spark.createDataFrame([("p1", iso(1), "D1", 1, 17.4, 78.4, "ON_TRIP", "live")], DRIVER_PINGS).write.parquet(f"{lake.landing}/pings")
    gold = medallion.run(spark, lake)
    assert rows(gold["zone_hourly_kpis"].select("pickup_zone_id", "requests")) == [(10, 2)]
    for table in ("bronze_trips", "silver_trips", "bronze_pings", "silver_pings"):
        files = [p.name for p in (tmp_path / "tables" / table).glob("part-*")]
        assert files and all(".zstd." in name for name in files)


def many_trips(spark, ids, name="concat('T', id)"):
    """A trip a minute for every id; each seventh has no zone."""
    return spark.range(*ids).select(
        F.expr(name).alias("trip_id"), F.concat(F.lit("D"), F.col("id") % 50).alias("driver_id"), F.lit("R").alias("rider_id"),
        F.expr("nullif(cast(id % 7 AS int), 0)").alias("pickup_zone_id"), F.lit(11).alias("dropoff_zone_id"),
        F.timestamp_seconds(1790000000 + F.col("id")).alias("request_time"), F.timestamp_seconds(1790000060 + F.col("id")).alias("pickup_time"),
        F.timestamp_seconds(1790000900 + F.col("id")).alias("dropoff_time"), (F.col("id") % 30).cast("double").alias("distance_km"),
        F.lit(100).cast("decimal(10,2)").alias("fare"), F.lit("COMPLETED").alias("status"), F.lit(None).cast("string").alias("cancel_reason"),
        F.timestamp_seconds(F.col("id")).alias("last_modified"))


def no_pings(spark, lake):
    spark.createDataFrame([], DRIVER_PINGS).write.parquet(f"{lake.landing}/pings")


def same_rows(found, expected):
    return found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_silver_holds_one_whole_row_of_each_key(spark, tmp_path):
    """Copies in one file and in others, in files of several bitmaps; copies that come a run later; no new files; an interrupted run."""
    lake = medallion.Lake(str(tmp_path / "landing"), str(tmp_path / "tables"), str(tmp_path / "check"))
    landing, silver = f"{lake.landing}/trips", lake.path("silver_trips")
    no_pings(spark, lake)
    trips = many_trips(spark, (70000,))
    shuffled = trips.union(trips.where("distance_km < 10")).orderBy(F.hash("trip_id"), "trip_id").coalesce(1)
    shuffled.write.mode("append").parquet(landing)
    trips.where("distance_km > 15").coalesce(1).write.mode("append").parquet(landing)
    nameless = trips.limit(9).withColumn("trip_id", F.lit(None).cast("string")).withColumn("pickup_zone_id", F.lit(3))
    nameless.coalesce(1).write.mode("append").parquet(landing)
    medallion.run(spark, lake)
    found = spark.read.parquet(silver)
    assert found.columns == trips.columns
    assert same_rows(found.where("trip_id IS NOT NULL"), trips.where("pickup_zone_id IS NOT NULL"))
    assert found.where("trip_id IS NULL").count() == 1
    assert not (tmp_path / "check" / "marks_trips").exists()

    many_trips(spark, (69990, 70010)).write.mode("append").parquet(landing)
    for _ in range(2):  # the second time nothing has landed
        medallion.run(spark, lake)
        assert same_rows(spark.read.parquet(silver).where("trip_id IS NOT NULL"), many_trips(spark, (70010,)).where("pickup_zone_id IS NOT NULL"))

    many_trips(spark, (70000, 70020)).write.mode("append").parquet(landing)
    medallion.bronze(spark, lake, "trips", TRIPS).awaitTermination()
    medallion.mark_first(spark, lake, medallion.SILVER[0]).awaitTermination()  # and there the driver died
    many_trips(spark, (70010, 70030)).write.mode("append").parquet(landing)
    medallion.run(spark, lake)
    assert same_rows(spark.read.parquet(silver).where("trip_id IS NOT NULL"), many_trips(spark, (70030,)).where("pickup_zone_id IS NOT NULL"))


def test_silver_moves_places_of_rows_and_leaves_the_session_as_it_was(spark, tmp_path):
    lake = medallion.Lake(str(tmp_path / "landing"), str(tmp_path / "tables"), str(tmp_path / "check"))
    no_pings(spark, lake)
    long_ids = "concat_ws('', transform(sequence(1, 20), x -> sha2(concat(id, '-', x), 512)))"
    trips = many_trips(spark, (2000,), long_ids)
    trips.union(trips).write.parquet(f"{lake.landing}/trips")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    medallion.run(spark, lake)
    assert same_rows(spark.read.parquet(lake.path("silver_trips")), trips.where("pickup_zone_id IS NOT NULL"))
    state = sum(p.stat().st_size for p in (tmp_path / "check").rglob("state/**/*") if p.is_file())
    assert 0 < state < 1_000_000  # the ids themselves are 2 MB, zipped
    assert spark.conf.get(provider) == before and spark.conf.get("parquet.page.size", None) is None

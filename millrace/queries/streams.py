"""Streaming jobs run to the end of the given tables, each against the batch SQL of the same question.

A table is landed as files below the shared folder and streamed from there with
the ``available_now`` trigger; what the sink holds afterwards is the result.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.layout import partition_count
from millrace.plans import mapping, visits
from millrace.queries import totals as _totals, trips as _trips  # noqa: F401  their SQL is shared
from millrace.queries.demand import SIZE, SLIDE, priced, windows as exact_windows
from millrace.queries.registry import SQL, big, query
from millrace.queries.views import REQUESTS, WINDOWS, with_
from millrace.session import shared_folder
from millrace.sinks.ledger import Ledger, batches_of, delivered, folder_writer
from millrace.sinks.streams import parquet_batch, start
from millrace.sources.stream import csv_files, file_topics, json_files, parquet_files
from millrace.streaming import alerts, archive, changelog, medallion, running, smoothing, windows
from millrace.streaming.metrics import BatchMetrics
from millrace.tables import CLICKSTREAM, CSV_TRANSACTIONS, DEPARTMENT_EVENTS, read

def landed(df: DataFrame, kind: str = "parquet", files: int = 4, **options: str) -> str:
    """``df`` as files of a new folder: as many as its partitions, but ``files`` at least."""
    path = shared_folder(df.sparkSession, "landing")
    df.repartition(max(files, partition_count(df))).write.options(**options).format(kind).save(path)
    return path


def written(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run ``stream`` over what is there; its output read back (the last state in complete mode)."""
    out, marks = shared_folder(spark, "stream"), shared_folder(spark, "marks")
    if mode == "append":
        query_ = start(stream, "parquet", checkpoint=marks, available_now=True, options={"path": out})
    else:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(out)
        query_ = start(stream, write, mode=mode, checkpoint=marks, available_now=True)
    query_.awaitTermination()
    return spark.read.parquet(out)


def staff_payments(spark, d):
    """Orders as a CSV feed of whole amounts."""
    return read(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("TransactionID"), F.col("o_custkey").cast("string").alias("EmployeeID"),
        F.col("o_orderpriority").alias("Department"), F.floor(F.col("o_totalprice") / 20).cast("int").alias("Amount"))


def department_events(spark, d):
    return read(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("transactionId"), F.col("o_custkey").cast("string").alias("employeeId"),
        F.col("o_orderpriority").alias("department"), F.floor(F.col("o_totalprice") / 20).cast("double").alias("amount"))


def clicks(spark, d):
    return read(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.col("event_type").alias("page"), F.col("ts").alias("event_time"))


_AMOUNT = "CAST(floor(o_totalprice / 20) AS INTEGER)"
_RISK = "CASE WHEN amount >= 10000 THEN 'HIGH_RISK' WHEN amount >= 5000 THEN 'SUSPICIOUS' ELSE 'NORMAL' END"
_ORDERS = "(SELECT o_orderpriority AS department, floor(o_totalprice / 20) AS amount FROM orders)"
_SUMS = """count(*) AS "transactionCount", CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS "totalAmount\""""


@query("stream_classified", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "TransactionID", {_AMOUNT} AS "Amount",
       CASE WHEN {_AMOUNT} >= 7000 THEN 'High' WHEN {_AMOUNT} >= 4000 THEN 'Medium' ELSE 'Low' END AS "transactionType"
FROM orders""")
def stream_classified(spark, d):
    """A CSV folder streamed, classified row by row and appended."""
    source = csv_files(spark, landed(staff_payments(spark, d), "csv", header="true"), CSV_TRANSACTIONS)
    return written(spark, alerts.classified(source, "Amount")).select("TransactionID", big("Amount").alias("Amount"), "transactionType")


def _json_departments(spark, d):
    return json_files(spark, landed(department_events(spark, d), "json"), DEPARTMENT_EVENTS, files_per_trigger=2)


@query("stream_department_totals", f"SELECT department, {_SUMS} FROM {_ORDERS} GROUP BY 1")
def stream_department_totals(spark, d):
    """Running totals in complete mode over two micro-batches."""
    totals = running.running_totals(_json_departments(spark, d), ["department"])
    return written(spark, totals, "complete").drop("averageAmount")


@query("stream_risk_totals", f'SELECT {_RISK} AS "riskLevel", {_SUMS} FROM {_ORDERS} GROUP BY 1')
def stream_risk_totals(spark, d):
    return written(spark, running.risk_totals(_json_departments(spark, d)), "complete").drop("averageAmount")


@query("stream_department_risk", f'SELECT department, {_RISK} AS "riskLevel", {_SUMS} FROM {_ORDERS} GROUP BY 1, 2')
def stream_department_risk(spark, d):
    """Totals per department and risk, sorted by the stream itself."""
    return written(spark, running.department_risk_totals(_json_departments(spark, d)), "complete").drop("averageAmount")


@query("stream_usable_events", "SELECT event_id, event_type FROM events WHERE event_id % 10 <> 0")
def stream_usable_events(spark, d):
    """Events whose time could not be read are dropped on the way."""
    spoilt = F.when(F.col("event_id").cast("bigint") % 10 != 0, F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    rows = clicks(spark, d).withColumn("event_time", F.coalesce(spoilt, F.lit("no time")))
    source = json_files(spark, landed(rows, "json"), CLICKSTREAM.replace("event_time timestamp", "event_time string"))
    timed = source.withColumn("event_time", F.try_to_timestamp("event_time"))
    return written(spark, windows.usable_events(timed)).select(big("event_id").alias("event_id"), "event_type")


@query("stream_tumbling_counts", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS count
FROM events GROUP BY ALL""")
def stream_tumbling_counts(spark, d):
    source = parquet_files(spark, landed(clicks(spark, d)), CLICKSTREAM)
    counts = windows.tumbling_counts(source, "event_time", "event_type", "1 hour")
    return written(spark, counts, "complete")


@query("stream_arrival_totals", f"""
SELECT department, count(*) AS transactions, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {_ORDERS} GROUP BY 1""")
def stream_arrival_totals(spark, d):
    """Windows of arrival time: how they fall is the clock's choice, what they hold together is not."""
    out = written(spark, windows.tumbling_totals_on_arrival(_json_departments(spark, d)), "complete")
    return out.groupBy("department").agg(F.sum("transactionCount").alias("transactions"),
                                         F.sum(F.col("totalAmount").cast("decimal(18,2)")).cast("double").alias("total"))


@query("stream_deduplicated", "SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time FROM events")
def stream_deduplicated(spark, d):
    """Every event landed twice, once more in a later file; one of each stays."""
    rows = clicks(spark, d)
    source = parquet_files(spark, landed(rows.unionAll(rows)), CLICKSTREAM)
    return written(spark, windows.deduplicated(source, "3650 days")).select("event_id", "event_time")


@query("stream_deduplicated_for_ever", "SELECT CAST(event_id AS VARCHAR) AS event_id FROM events")
def stream_deduplicated_for_ever(spark, d):
    """Without a watermark: copies that land a run later, with any time, are known all the same."""
    rows, landing = clicks(spark, d), shared_folder(spark, "landing")
    out, marks = shared_folder(spark, "stream"), shared_folder(spark, "marks")
    for days in (0, 4000):
        rows.withColumn("event_time", F.col("event_time") + F.make_dt_interval(days=F.lit(days))).write.mode("append").parquet(landing)
        source = windows.deduplicated(parquet_files(spark, landing, CLICKSTREAM), None, by_id_only=True)
        start(source, "parquet", checkpoint=marks, available_now=True, options={"path": out}).awaitTermination()
    return spark.read.parquet(out).select("event_id")


@query("stream_deduplicated_by_id", "SELECT CAST(event_id AS VARCHAR) AS event_id FROM events")
def stream_deduplicated_by_id(spark, d):
    rows = clicks(spark, d)
    later = rows.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 MINUTE"))
    source = parquet_files(spark, landed(rows.unionAll(later)), CLICKSTREAM)
    return written(spark, windows.deduplicated(source, "3650 days", by_id_only=True)).select("event_id")


@query("stream_sliding_demand", with_(WINDOWS) + """
SELECT zone_id, window_start, window_end, demand, drivers_available, drivers_on_trip, true AS close_to_exact FROM windows""")
def stream_sliding_demand(spark, d):
    """Both kinds of events in one stream of panes whose driver sketches are united into sliding windows.

    Sketches are exact for a few hundred drivers; ``close_to_exact`` holds both
    estimates against the exact counts of the batch job, at 2 %.
    """
    requests, pings = mapping.raw_requests(spark, d), mapping.raw_pings(spark, d)
    streams = [parquet_files(spark, landed(x), x.schema.simpleString()[7:-1].replace(":", " ")) for x in (requests, pings)]
    panes = written(spark, windows.pane_sketches(*streams, f"{SLIDE} seconds", "3650 days"), "complete")
    exact = exact_windows(spark, d).select("zone_id", "window_start", F.col("drivers_available").alias("_a"),
                                           F.col("drivers_on_trip").alias("_b"))
    near = [F.abs(F.col(x) - F.col(y)) <= 0.02 * F.col(y) for x, y in (("drivers_available", "_a"), ("drivers_on_trip", "_b"))]
    found = windows.windows_of_panes(panes, SIZE, SLIDE).join(exact, ["zone_id", "window_start"], "left")
    return found.select(big("zone_id").alias("zone_id"), "window_start", "window_end", "demand", "drivers_available",
                        "drivers_on_trip", F.coalesce(near[0] & near[1], F.lit(False)).alias("close_to_exact"))


@query("stream_smoothed")
def stream_smoothed(spark, d):
    """Step-limited multipliers from a state per zone, equal to the batch recurrence."""
    rows = priced(spark, d).select(F.col("zone_id").cast("int").alias("zone_id"), "window_end", "surge_multiplier")
    landing = shared_folder(spark, "landing")
    rows.repartitionByRange("window_end").write.parquet(landing)
    source = parquet_files(spark, landing, "zone_id int, window_end timestamp, surge_multiplier double")
    return written(spark, smoothing.smoothed(source, SLIDE)).withColumn("zone_id", big("zone_id"))


SQL["stream_smoothed"] = SQL["surge_smoothed"]


@query("stream_medallion")
def stream_medallion(spark, d):
    """Landing to silver to gold: every trip lands twice and counts once."""
    trips = mapping.trips(spark, d).select(
        # The given lines repeat their keys now and then; these are trips of their own.
        F.concat_ws("-", "trip_id", F.unix_timestamp("request_time"), "distance_km", "fare", "status", "cancel_reason").alias("trip_id"),
        F.col("driver_id").cast("string").alias("driver_id"), F.col("rider_id").cast("string").alias("rider_id"),
        "pickup_zone_id", "dropoff_zone_id", "request_time", "pickup_time", "dropoff_time", "distance_km",
        F.col("fare").cast("decimal(10,2)").alias("fare"), "status", "cancel_reason",
        F.col("request_time").alias("last_modified"))
    pings = mapping.raw_pings(spark, d).select(
        F.col("event_id").cast("string").alias("event_id"), F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        "driver_id", "zone_id", "lat", "lon", "status", F.lit("live").alias("source"))
    base = shared_folder(spark, "lake")
    lake = medallion.Lake(f"{base}/landing", f"{base}/tables", f"{base}/marks", "3650 days")
    for name, rows in (("trips", trips.unionAll(trips)), ("pings", pings)):
        rows.write.options(compression=lake.compression, **medallion.PARQUET).parquet(f"{lake.landing}/{name}")
    return medallion.run(spark, lake)["zone_hourly_kpis"].withColumn("pickup_zone_id", big("pickup_zone_id"))


SQL["stream_medallion"] = SQL["zone_hour_kpis_lake"]


@query("stream_topic_archive", with_(REQUESTS) + """
SELECT CAST(event_id AS VARCHAR) AS event_id, zone_id, event_id % 3 AS partition, event_id AS "offset" FROM requests""")
def stream_topic_archive(spark, d):
    """A topic of JSON payloads landed as typed Parquet with partition and offset."""
    requests = mapping.raw_requests(spark, d)
    payload = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "zone_id"))
    base, out, marks = (shared_folder(spark, n) for n in ("topics", "archive", "marks"))
    (requests.select(payload.alias("value"), (F.col("event_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"))
     .write.json(f"{base}/trip_requests"))
    schema = {"trip_requests": "event_id string, zone_id int"}
    for q in archive.topics(file_topics(spark, base), out, marks, schema, available_now=True).values():
        q.awaitTermination()
    return spark.read.parquet(f"{out}/trip_requests").select(
        "event_id", big("zone_id").alias("zone_id"), big("partition").alias("partition"), "offset")


@query("stream_raw_archive", "SELECT count(*) AS lines, sum(length(props)) AS characters FROM events")
def stream_raw_archive(spark, d):
    """Payloads kept as they came, as text."""
    base, out, marks = (shared_folder(spark, n) for n in ("topics", "raw", "marks"))
    (read(spark, d, "events").select(F.col("props").alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
     .write.json(f"{base}/visits"))
    archive.raw_text(file_topics(spark, base)("visits"), out, marks, interval=None, available_now=True).awaitTermination()
    lines = spark.read.text(out)
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters"))


@query("stream_visits_table", SQL["visit_stats"])
def stream_visits_table(spark, d):
    """Visit events land from a topic in a table, and the statistics are asked of the table."""
    base, out, marks = (shared_folder(spark, n) for n in ("topics", "visits", "marks"))
    payload = F.to_json(F.struct(F.col("user_id").cast("string").alias("visitor_id"), F.col("event_type").alias("page"),
                                 F.col("ts").cast("string").alias("timestamp")))
    (read(spark, d, "events").select(payload.alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
     .write.json(f"{base}/visits"))
    archive.visits(file_topics(spark, base), "visits", out, marks, available_now=True).awaitTermination()
    return visits.visit_stats(spark.read.parquet(out))


@query("stream_restarted", "SELECT CAST(event_id AS VARCHAR) AS event_id FROM events")
def stream_restarted(spark, d):
    """A stream stopped and started again from its checkpoint reads the new files only."""
    rows, landing = clicks(spark, d), shared_folder(spark, "landing")
    out, marks = shared_folder(spark, "stream"), shared_folder(spark, "marks")
    for part in (0, 1):
        rows.where(F.col("event_id").cast("bigint") % 2 == part).write.mode("append").parquet(landing)
        start(parquet_files(spark, landing, CLICKSTREAM), "parquet", checkpoint=marks, available_now=True,
              options={"path": out}).awaitTermination()
    return spark.read.parquet(out).select("event_id")


@query("stream_replayed_batch", "SELECT event_id FROM events")
def stream_replayed_batch(spark, d):
    """A batch written twice under one id is there once."""
    out = shared_folder(spark, "batches")
    rows = read(spark, d, "events").select("event_id")
    for _ in range(2):
        parquet_batch(out)(rows, 7)
    return spark.read.parquet(out).select("event_id")


def _in_two_runs(spark: SparkSession, rows: DataFrame, second, run) -> None:
    """``run(landing)`` twice, after each half of ``rows`` has landed; those where ``second`` holds come later."""
    landing = shared_folder(spark, "landing")
    for half in (~second, second):
        rows.where(half).write.mode("append").parquet(landing)
        run(landing)


@query("stream_late_rows", """
WITH parts AS (SELECT ts, event_id % 3 = 0 AS later FROM events),
mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 5 DAY AS w FROM parts WHERE NOT later)
SELECT count(*) AS rows_read, count(*) FILTER (WHERE later AND ts <= w) AS late,
       count(*) FILTER (WHERE NOT (later AND ts <= w)) AS kept
FROM parts, mark""")
def stream_late_rows(spark, d):
    """A third of the events lands late: what the watermark drops is counted by the stream's own metrics."""
    out, marks = shared_folder(spark, "stream"), shared_folder(spark, "marks")
    with BatchMetrics(spark) as metrics:
        def run(landing: str) -> None:
            source = windows.deduplicated(parquet_files(spark, landing, CLICKSTREAM), "5 days")
            metrics.finished(start(source, "parquet", checkpoint=marks, available_now=True, options={"path": out}))

        _in_two_runs(spark, clicks(spark, d), F.col("event_id").cast("bigint") % 3 == 0, run)
        seen = metrics.table().agg(F.sum("rows_read").alias("rows_read"), F.sum("late_rows").alias("late"))
    kept = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("kept"))
    return seen.withColumn("kept", kept.scalar())


@query("stream_multi_sink", """
SELECT sink, count(*) AS rows, sum(event_id) AS ids, 2 AS batches, 2 AS writes
FROM events, (VALUES ('messages'), ('table')) AS s(sink) GROUP BY sink""")
def stream_multi_sink(spark, d):
    """Two sinks, the second of which dies once in the middle of a batch: after the restart both hold every row once."""
    base, marks = shared_folder(spark, "sinks"), shared_folder(spark, "marks")
    ledger, writes, broken = Ledger(spark, f"{base}/ledger"), [], ["messages"]

    def watched(name: str, writer):
        def write(rows: DataFrame, path: str) -> None:
            writer(rows, path)
            if name in broken:
                broken.remove(name)
                raise RuntimeError("planted: the sink died with its batch half delivered")
            writes.append(name)
        return write

    kinds = {"table": "parquet", "messages": "json"}
    sinks = {name: (watched(name, folder_writer(kind)), f"{base}/{name}") for name, kind in kinds.items()}

    def run(landing: str) -> None:
        for _ in range(2):
            query_ = start(parquet_files(spark, landing, CLICKSTREAM), delivered(ledger, sinks), checkpoint=marks, available_now=True)
            try:
                return query_.awaitTermination()
            except StreamingQueryException as died:
                if "planted" not in str(died):
                    raise
        raise RuntimeError("the stream died twice")

    _in_two_runs(spark, clicks(spark, d).select("event_id", "user_id", "event_type", "page", "event_time"),
                 F.col("event_id").cast("bigint") % 2 == 1, run)
    count = spark.createDataFrame([(n, writes.count(n)) for n in kinds], "sink string, writes bigint")
    held = [batches_of(spark, f"{base}/{name}", kind, "event_id string").select(F.lit(name).alias("sink"), "event_id", "batch_id")
            for name, kind in kinds.items()]
    return held[0].unionByName(held[1]).groupBy("sink").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("event_id").cast("bigint")).alias("ids"),
        F.count_distinct("batch_id").alias("batches")).join(count, "sink")


@query("stream_update_merged", f"SELECT department, {_SUMS} FROM {_ORDERS} GROUP BY 1")
def stream_update_merged(spark, d):
    """Running totals in update mode: batches emit what changed, the newest row of each key is the table."""
    out, marks = shared_folder(spark, "changes"), shared_folder(spark, "marks")
    schema = "department string, transactionCount bigint, totalAmount double, averageAmount double"

    def run(landing: str) -> None:
        source = parquet_files(spark, landing, DEPARTMENT_EVENTS)
        start(running.running_totals(source, ["department"]), changelog.change_batch(out), mode="update", checkpoint=marks,
              available_now=True).awaitTermination()

    _in_two_runs(spark, department_events(spark, d), F.col("transactionId").cast("bigint") % 2 == 1, run)
    return changelog.newest(changelog.read_changes(spark, out, schema), ["department"]).drop("averageAmount")

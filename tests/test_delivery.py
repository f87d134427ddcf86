"""Late rows, delivery to several sinks, changelogs and mergeable sketches, each against a plain count."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from support import rows
from millrace.plans import demand
from millrace.sinks.ledger import Ledger, agreement, batches_of, delivered, folder_writer
from millrace.sinks.streams import start
from millrace.sources.stream import parquet_files
from millrace.streaming import changelog, windows
from millrace.streaming.metrics import BatchMetrics

EVENTS = "event_id string, event_time timestamp"
NOON = dt.datetime(2024, 1, 1, 12)


def minutes(spark, spec):
    return spark.createDataFrame([(i, NOON + dt.timedelta(minutes=m)) for i, m in spec], EVENTS)


# ---- late rows ----------------------------------------------------------------

def test_rows_read_are_kept_or_late(spark, tmp_path):
    landing, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    first = [(f"a{m}", m) for m in range(0, 60, 5)]
    second = [(f"b{m}", m) for m in range(0, 60, 5)] + [("b44.9", 44.9), ("b45.1", 45.1), ("a55", 55)]
    with BatchMetrics(spark) as metrics:
        for spec in (first, second):
            minutes(spark, spec).write.mode("append").parquet(landing)
            stream = windows.deduplicated(parquet_files(spark, landing, EVENTS), "10 minutes")
            metrics.finished(start(stream, "parquet", checkpoint=marks, available_now=True, options={"path": out}))
        table = metrics.table()
        got = table.agg(F.sum("rows_read"), F.sum("late_rows")).first()
        assert dict(table.dtypes)["watermark"] == "string" and table.select("query").distinct().count() == 1
    late = [i for i, m in second if m <= 55 - 10]  # behind the newest event of the run before, less the delay
    kept = {i for i, _ in first} | {i for i, _ in second} - set(late)
    assert {r[0] for r in spark.read.parquet(out).select("event_id").collect()} == kept
    assert tuple(got) == (len(first) + len(second), len(late)) and len(late) == 11
    # Nothing is heard any more once it is detached.
    stream = parquet_files(spark, landing, EVENTS)
    start(stream, "noop", available_now=True).awaitTermination()
    assert metrics.table().count() == table.count()


# ---- several sinks --------------------------------------------------------------

@pytest.mark.parametrize("point", ["before", "written", "published"])
def test_a_batch_that_dies_anywhere_is_completed_once(spark, tmp_path, monkeypatch, point):
    landing, marks = str(tmp_path / "in"), str(tmp_path / "marks")
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    planted, attempts = [True], []

    def die(at):
        if at == point and planted:
            planted.clear()
            raise RuntimeError("planted")

    def writer(name, kind):
        def write(df, path):
            attempts.append(name)
            if name == "second":
                die("before")
            folder_writer(kind)(df, path)
            if name == "second":
                die("written")
        return write

    commit = Ledger.commit

    def committing(self, batch_id, sink, n):
        if sink == "second":
            die("published")
        commit(self, batch_id, sink, n)

    monkeypatch.setattr(Ledger, "commit", committing)
    sinks = {n: (writer(n, k), str(tmp_path / n)) for n, k in (("first", "parquet"), ("second", "json"), ("third", "parquet"))}
    died = 0
    for k in range(3):
        minutes(spark, [(f"{k}-{i}", i) for i in range(10 + k)]).write.mode("append").parquet(landing)
        for _ in range(2):
            query = start(parquet_files(spark, landing, EVENTS), delivered(ledger, sinks), checkpoint=marks, available_now=True)
            try:
                query.awaitTermination()
                break
            except StreamingQueryException:
                died += 1
    assert died == 1 and not planted
    assert attempts.count("first") == attempts.count("third") == 3
    assert attempts.count("second") == (3 if point == "published" else 4)
    want = sorted(f"{k}-{i}" for k in range(3) for i in range(10 + k))
    for n, kind in (("first", "parquet"), ("second", "json"), ("third", "parquet")):
        held = batches_of(spark, str(tmp_path / n), kind, "event_id string")
        assert sorted(r[0] for r in held.select("event_id").collect()) == want
    assert rows(agreement(ledger)) == [(k, 3, True, 10 + k) for k in range(3)]


def test_a_replayed_batch_writes_nothing(spark, tmp_path):
    ledger, calls = Ledger(spark, str(tmp_path / "ledger")), []
    assert ledger.table().count() == 0

    def write(df, path):
        calls.append(path)
        df.write.parquet(path)

    deliver = delivered(ledger, {"only": (write, str(tmp_path / "out"))}, prepare=lambda b, i: b.withColumn("twice", F.col("id") * 2))
    for batch_id, n in ((0, 5), (0, 5), (1, 0), (1, 0)):
        deliver(spark.range(n), batch_id)
    assert len(calls) == 2 and rows(ledger.table()) == [("only", 0, 1), ("only", 5, 0)]
    assert batches_of(spark, str(tmp_path / "out"), "parquet", "id bigint, twice bigint").agg(F.sum("twice")).first()[0] == 20


# ---- changelogs -------------------------------------------------------------------

def test_newest_change_of_each_key(spark, tmp_path):
    rng, path, want = random.Random(1), str(tmp_path / "log"), {}
    schema = "k int, v int, w string"
    for batch_id in range(8):
        changed = {None if rng.random() < 0.1 else rng.randrange(40): rng.randrange(1000) for _ in range(25)} | {7: batch_id}
        data = [(k, None if v % 9 == 0 else v, f"{batch_id}") for k, v in changed.items()]
        changelog.change_batch(path)(spark.createDataFrame(data, schema), batch_id)
        changelog.change_batch(path)(spark.createDataFrame(data, schema), batch_id)  # replayed
        want |= {k: (k, v, w) for k, v, w in data}
    read = changelog.read_changes(spark, path, schema)
    assert rows(changelog.newest(read, ["k"])) == sorted(want.values(), key=repr)
    assert changelog.read_changes(spark, path, schema, since=6).select("batch_id").distinct().count() == 2
    target = str(tmp_path / "compacted")
    assert changelog.compact(spark, path, target, schema, ["k"]) == 7
    changelog.change_batch(target)(spark.createDataFrame([(7, 5, "new")], schema), 8)
    want[7] = (7, 5, "new")
    assert rows(changelog.newest(changelog.read_changes(spark, target, schema), ["k"])) == sorted(want.values(), key=repr)


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    changes = spark.range(20_000).selectExpr("if(id % 3 = 0, 1, id) AS k", "id AS v", "id AS batch_id")
    got = changelog.newest(changes, ["k"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") == 1
    assert got.where("k = 1").first()["v"] == 19_998


# ---- sketches ----------------------------------------------------------------------

def test_united_panes_equal_the_exact_batch(spark):
    rng = random.Random(2)
    at = lambda: NOON + dt.timedelta(seconds=rng.randrange(1800))
    requests = spark.createDataFrame([(str(i), at(), rng.choice([1, 1, 1, 2, None])) for i in range(400)],
                                     "event_id string, event_time timestamp, zone_id int")
    pings = spark.createDataFrame(
        [(f"p{i}", at(), rng.choice([1, 1, 2, None]), rng.choice([None, *map(str, range(60))]), rng.choice(["AVAILABLE", "ON_TRIP", None]))
         for i in range(900)], "event_id string, event_time timestamp, zone_id int, driver_id string, status string")
    panes = windows.pane_sketches(requests, pings.unionAll(pings))
    from millrace.operators.dedup import union_events
    exact = demand.sliding_demand_supply(union_events(requests, pings))
    assert rows(windows.windows_of_panes(panes)) == rows(exact.select("zone_id", "window_start", "window_end", "demand",
                                                                      "drivers_available", "drivers_on_trip"))
    with pytest.raises(ValueError):
        windows.windows_of_panes(panes, 300, 70)


def test_large_sketches_stay_within_two_percent(spark):
    pings = spark.range(120_000).selectExpr(
        "cast(id AS string) AS event_id", "timestamp'2024-01-01 12:00:00' + make_dt_interval(0, 0, 0, id % 300) AS event_time",
        "if(id % 3 = 0, 1, 2) AS zone_id", "cast(id % 50000 AS string) AS driver_id", "'AVAILABLE' AS status")
    requests = pings.where("false").select("event_id", "event_time", "zone_id")
    for r in windows.windows_of_panes(windows.pane_sketches(requests, pings)).where(
            "window_start = timestamp'2024-01-01 12:00:00'").collect():
        exact = pings.where(F.col("zone_id") == r["zone_id"]).select("driver_id").distinct().count()
        assert abs(r["drivers_available"] - exact) <= 0.02 * exact and r["drivers_on_trip"] == 0


def test_copies_after_any_time_without_a_watermark(spark, tmp_path):
    landing, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    for spec in ([("a", 0), ("b", 1)], [("a", 10**6), ("c", 10**6 + 1)], [("b", -10**6), ("c", 10**6 + 1)]):
        minutes(spark, spec).write.mode("append").parquet(landing)
        stream = windows.deduplicated(parquet_files(spark, landing, EVENTS), None, by_id_only=True)
        start(stream, "parquet", checkpoint=marks, available_now=True, options={"path": out}).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(out).select("event_id").collect()) == ["a", "b", "c"]

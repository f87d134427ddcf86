"""Jobs on hand-made rows with answers worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from support import rows
from millrace.functions.geo import zone_table
from millrace.functions.pricing import priced
from millrace.operators import quality
from millrace.plans import billing, demand, forecast, logs, transactions, trips, visits, warehouse
from millrace.tables import (CITY_ZONES, DRIVERS, INSURANCE, LOG_LINES, PAYMENTS, PROCEDURES, TRANSACTIONS_TEXT, TRIPS,
                             VISITS)


def T(text):
    return dt.datetime.fromisoformat(text)


# ---- transactions ----------------------------------------------------------

@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame([
        ("T1", "C1", "2026-10-01 09:00:00", "1200.50", "electronics", "SUCCESS"),
        ("T2", "C2", "2026-10-01 10:00:00", "325.25", "grocery", "FAILED"),
        ("T3", "C3", "2026-10-02 10:00:00", "0.00", "food", "SUCCESS"),
        ("T4", "C3", "2026-10-02 10:00:00", "-5", "food", "SUCCESS"),
        ("T5", " ", "2026-10-02 10:00:00", "5", "food", "SUCCESS"),
        ("T6", "C3", "not-a-timestamp", "5", "food", "SUCCESS"),
        ("T7", "C3", "2026-10-02 10:00:00", "not-a-number", "food", "SUCCESS"),
        ("T8", "C3", "2026-10-02 10:00:00", "5", None, "SUCCESS")], TRANSACTIONS_TEXT)


def test_dirty_transactions(dirty, spark, tmp_path):
    counts = transactions.run(dirty, str(tmp_path))
    assert counts == {"raw_rows": 8, "valid_rows": 3, "rejected_rows": 5}
    daily = spark.read.parquet(f"{tmp_path}/daily_summary")
    assert rows(daily) == [(dt.date(2026, 10, 1), 2, 1525.75), (dt.date(2026, 10, 2), 1, 0.0)]
    category = spark.read.parquet(f"{tmp_path}/category_summary")
    assert rows(category) == [("electronics", 1, 1200.5), ("food", 1, 0.0), ("grocery", 1, 325.25)]


# ---- billing ---------------------------------------------------------------

def test_billing(spark):
    day = dt.date(2026, 1, 1)
    visits_ = spark.createDataFrame([(f"V{i}", f"P{i}", day, "Cardiology" if i < 4 else "General", "D") for i in range(1, 6)], VISITS)
    procedures = spark.createDataFrame(
        [("A", "V1", "x", 4000.0), ("B", "V1", "y", 2000.0), ("C", "V2", "x", 1000.0), ("D", "V3", "x", 500.0),
         ("E", "V4", "x", 300.0)], PROCEDURES)
    insurance = spark.createDataFrame([("P1", "I", 80.0), ("P2", "I", 50.0)], INSURANCE)
    payments = spark.createDataFrame(
        [("1", "V1", day, 2000.0, "card"), ("2", "V1", day, 1000.0, "cash"), ("3", "V2", day, 200.0, "card"),
         ("4", "V4", day, 300.0, "card")], PAYMENTS)
    out = billing.billing_records(visits_, procedures, insurance, payments)
    got = {r["visit_id"]: (r["total_bill"], r["insurance_covered"], r["amount_paid"], r["outstanding_balance"],
                           r["billing_status"]) for r in out.collect()}
    assert got == {"V1": (6000.0, 4800.0, 3000.0, 0.0, "PAID"), "V2": (1000.0, 500.0, 200.0, 300.0, "OUTSTANDING"),
                   "V3": (500.0, 0.0, 0.0, 500.0, "OUTSTANDING"), "V4": (300.0, 0.0, 300.0, 0.0, "PAID")}
    want = [("Cardiology", 3, 7500.0, 2500.0)]
    assert rows(billing.department_revenue(out, 1000)) == want
    assert rows(billing.department_revenue_sql(out, 1000.0)) == want
    assert out.select(billing.status(F.lit(2.0), "DUE").alias("s")).first()["s"] == "DUE"


# ---- logs and visits -------------------------------------------------------

def test_logs(spark):
    lines = spark.createDataFrame(
        [("2026-01-01 10:00:00", "INFO", "1.1", "/a", 200, 100), ("2026-01-01 10:00:01", "ERROR", "1.1", "/b", 500, 900),
         ("bad", "INFO", "2.2", "/a", 200, 300)], LOG_LINES)
    typed = logs.typed(lines)
    assert [r["timestamp"] for r in typed.collect()][2] is None
    assert logs.ranking(typed, "url").first()[0:2] == ("/a", 2)
    assert rows(logs.ranking(typed, "url", only_errors=True)) == [("/b", 1)]
    assert rows(logs.ranking(typed, "ip")) == [("1.1", 2), ("2.2", 1)]
    assert rows(logs.status_counts(typed)) == [(200, 2), (500, 1)]
    assert logs.performance(typed).first()[0:2] == ("/b", 900.0)
    assert logs.slow_requests(typed).count() == 1 and logs.errors(typed).count() == 1
    share = logs.error_share(typed).first()
    assert share["total_errors"] == 1 and abs(share["error_percentage"] - 100 / 3) < 1e-9
    assert logs.error_share(typed.limit(0)).first()["error_percentage"] is None


def test_visits(spark):
    v = spark.createDataFrame([(i, f"u{i % 3}", "/home" if i % 2 else "/cart") for i in range(15)],
                              "id int, visitor_id string, page string")
    assert visits.visit_stats(v).first()[0:5] == (15, 3, 2, "/cart", 8)
    assert [r["id"] for r in visits.recent_visits(v, "id", ["page"]).collect()] == list(range(14, 4, -1))
    assert visits.visit_stats(v.limit(0)).first()[0:4] == (0, 0, 0, None)


# ---- trips -----------------------------------------------------------------

def trip(i, zone=10, drop=11, request="2026-10-05 08:00:00", wait=5, ride=40, fare="100.00", status="COMPLETED", driver="D1",
         km=10.0, reason=None):
    r = None if request is None else T(request)
    pickup = None if wait is None else (r or T("2026-10-05 08:00:00")) + dt.timedelta(minutes=wait)
    dropoff = None if pickup is None or ride is None else pickup + dt.timedelta(minutes=ride)
    return (f"T{i}", driver, "R1", zone, drop, r, pickup, dropoff, km, None if fare is None else Decimal(fare), status, reason, r)


@pytest.fixture(scope="module")
def few_trips(spark):
    return spark.createDataFrame([
        trip(1), trip(2), trip(3, request="2026-10-05 09:10:00", wait=None, status="CANCELLED", reason="NO_SHOW"),
        trip(4, fare="-1.00"), trip(5, ride=-10)], TRIPS)


def test_trip_rules(few_trips, spark):
    valid = quality.apply_rules(few_trips, quality.trip_rules())
    assert valid.count() == 3
    assert rows(trips.peak_hours(valid)) == [(8, 2), (9, 1)]
    assert rows(trips.cancel_reasons(valid)) == [(10, 9, "NO_SHOW", 1)]
    edge = spark.createDataFrame([trip(1, zone=0), trip(2, zone=41), trip(3, zone=None), trip(4, drop=40), trip(5, fare=None)], TRIPS)
    assert rows(quality.apply_rules(edge, quality.trip_rules()).select("trip_id")) == [("T4",), ("T5",)]
    assert quality.apply_rules(edge, quality.warehouse_trip_rules()).count() == 4
    early = spark.createDataFrame([trip(1, wait=-3)], TRIPS)
    assert quality.apply_rules(early, quality.warehouse_trip_rules()).count() == 1
    assert quality.apply_rules(early, quality.lake_trip_rules()).count() == 0
    report = {r["rule"]: r["violations"] for r in quality.violation_report(few_trips, quality.trip_rules()).collect()}
    assert report == {"pickup_zone": 0, "dropoff_zone": 0, "fare_not_negative": 1, "dropoff_after_pickup": 1}
    assert quality.reject_accounting(few_trips, quality.all_hold(quality.trip_rules())).first()[0:3] == (5, 3, 2)


def test_a_failing_rule_stops_the_job(few_trips):
    rule = quality.Expectation("fare_known", F.col("fare") >= 0, "fail")
    with pytest.raises(Exception, match="fare_known"):
        quality.apply_rules(few_trips, [rule]).collect()


def test_missing_times_count_as_minus_one(spark):
    none = spark.createDataFrame([trip(1, request=None, wait=None)], TRIPS)
    assert rows(trips.peak_hours(none)) == [(-1, 1)]
    by_pickup = spark.createDataFrame([trip(1, request=None, wait=90)], TRIPS)
    assert rows(trips.peak_hours(by_pickup)) == [(9, 1)]


def test_hourly_kpis_and_gate(spark):
    t = spark.createDataFrame([trip(i) for i in range(12)] + [trip(13, wait=None, status="CANCELLED", km=None, fare=None)], TRIPS)
    kpis = trips.zone_hour_kpis(t)
    row = kpis.first()
    assert (row["requests"], row["completed"], row["cancelled"], row["avg_eta_min"], row["revenue_inr"], row["km"],
            row["revenue_per_km"]) == (13, 12, 1, 5.0, 1200.0, 120.0, 10.0)
    quality.require_clean(quality.kpi_gate_report(kpis))
    with pytest.raises(quality.QualityError, match="unbalanced"):
        quality.require_clean(quality.kpi_gate_report(kpis.withColumn("requests", F.col("requests") + 5)))
    standing = spark.createDataFrame([trip(1, km=0.0)], TRIPS)
    assert trips.zone_hour_kpis(standing).first()["revenue_per_km"] is None
    assert trips.revenue_per_km(standing).first()["revenue_per_km"] == 100.0 / 0.001


def test_payout(spark):
    twelve = [trip(i, driver="A") for i in range(12)]
    eleven = [trip(20 + i, driver="B") for i in range(11)]
    t = spark.createDataFrame(twelve + eleven + [trip(40, driver="C", status="CANCELLED")], TRIPS)
    surge = spark.createDataFrame([(T("2026-10-05 08:00:00"),)], "hour_ts timestamp")
    out = {r["driver_id"]: r for r in trips.driver_payout(t, F.to_date("request_time"), surge).collect()}
    assert set(out) == {"A", "B"}
    assert (out["A"]["utilisation"], out["A"]["bonus_inr"], out["A"]["surge_pay_inr"]) == (0.8, 150.0, 120.0)
    assert out["B"]["bonus_inr"] == 0.0 and out["B"]["total_incentive_inr"] == 110.0
    plain = trips.driver_payout(t, F.to_date("request_time")).first()
    assert plain["driver_id"] == "A" and plain["total_incentive_inr"] == 150.0
    long = spark.createDataFrame([trip(1, ride=900)], TRIPS)
    assert trips.driver_payout(long, F.to_date("request_time")).first()["utilisation"] == 1.0


def test_kpi_summary(few_trips):
    valid = quality.apply_rules(few_trips, quality.trip_rules())
    row = trips.kpi_summary(valid, "2026-10-05").first()
    assert (row["completed_trips"], row["cancel_rate"], row["avg_rider_eta_min"], row["eta_target_met"],
            row["revenue_inr"], row["revenue_per_km_inr"]) == (2, 0.3333, 5.0, False, 200.0, 10.0)
    assert trips.kpi_summary(valid, "2020-01-01").count() == 0


def test_bi_measures_divide_by_zero(spark):
    fact = spark.createDataFrame([(3.0, 10.0, 50.0, 0.0)], "wait_time_min double, duration_min double, fare_inr double, distance_km double")
    online = spark.createDataFrame([(20.0,)], "online_minutes double")
    surge = spark.createDataFrame([(1.0,), (2.0,)], "surge_multiplier double")
    assert trips.bi_measures(fact, online, surge).first()[0:4] == (3.0, 0.5, 0.0, 1.5)


def test_zone_overview_defaults(spark, few_trips):
    kpis = trips.zone_hour_kpis(quality.apply_rules(few_trips, quality.trip_rules()))
    latest = spark.createDataFrame([(10, 5, 4, 1.2, 1.25)], "zone_id int, demand bigint, supply bigint, surge_multiplier double, ratio double")
    out = {r["zone_id"]: r for r in trips.zone_overview(zone_table(spark), kpis, latest).collect()}
    assert len(out) == 40 and out[10]["demand"] == 5 and out[10]["requests"] == 3
    z = out[1]
    assert (z["surge_multiplier"], z["ratio"], z["demand"], z["supply"]) == (
        1.0, 1.1, int(z["demand_weight"] * 25), int(z["demand_weight"] * 22))


# ---- pricing ---------------------------------------------------------------

@pytest.mark.parametrize("demand_,supply,rain,temp,previous,multiplier", [
    (20, 10, 3.0, 20.0, None, 2.2), (30, 10, None, None, None, 2.0), (301, 100, None, None, None, 2.5),
    (5, 10, None, None, None, 1.0), (10, 10, None, None, None, 1.2), (15, 10, None, None, None, 1.5),
    (5, 0, None, None, None, 2.5), (40, 10, 2.5, 36.0, None, 2.8), (40, 10, 2.4, 35.0, None, 2.5),
    (40, 10, None, None, 1.0, 1.3), (5, 10, None, None, 2.0, 1.7), (40, 10, 2.5, 4.9, 2.9, 2.8)])
def test_prices(spark, demand_, supply, rain, temp, previous, multiplier):
    df = spark.createDataFrame([(demand_, supply, rain, temp, previous)], "d int, s int, r double, t double, p double")
    out = df.select(priced(F.col("d"), F.col("s"), F.col("r"), F.col("t"), F.col("p"))["surge_multiplier"].alias("m"))
    assert out.first()["m"] == multiplier


def test_cap(spark):
    from millrace.functions.pricing import smooth_step
    df = spark.createDataFrame([(3.5, None), (3.5, 2.9)], "t double, p double")
    assert [r[0] for r in df.select(smooth_step(F.col("t"), F.col("p"))).collect()] == [3.0, 3.0]


def events_frame(spark, rows_):
    return spark.createDataFrame(rows_, "event_id string, event_time timestamp, zone_id int, kind string, driver_id string, status string")


def test_sliding_windows_by_brute_force(spark):
    import random
    random.seed(5)
    start = T("2026-10-12 12:00:00")
    data = []
    for i in range(400):
        t = start + dt.timedelta(seconds=random.randrange(1200))
        kind = random.choice(["request", "ping"])
        status = None if kind == "request" else random.choice(["AVAILABLE", "ON_TRIP", "OFFLINE"])
        data.append((f"e{i}", t, random.choice([1, 1, 1, 2]), kind, None if kind == "request" else f"d{random.randrange(20)}", status))
    got = demand.sliding_demand_supply(events_frame(spark, data + data[:50]))
    want = {}
    for _, t, zone, kind, driver, status in data:
        first = t.replace(second=0) - dt.timedelta(minutes=4)
        for k in range(5):
            w = want.setdefault((zone, first + dt.timedelta(minutes=k)), [0, set(), set()])
            if kind == "request":
                w[0] += 1
            elif status == "AVAILABLE":
                w[1].add(driver)
            elif status == "ON_TRIP":
                w[2].add(driver)
    assert {(r["zone_id"], r["window_start"]): (r["demand"], r["drivers_available"], r["drivers_on_trip"])
            for r in got.collect()} == {k: (v[0], len(v[1]), len(v[2])) for k, v in want.items()}


def test_window_must_fit_the_slide(spark):
    with pytest.raises(ValueError):
        demand.sliding_demand_supply(events_frame(spark, []), 300, 70)


def test_store(spark):
    schema = "zone_id int, window_end timestamp, surge_multiplier double"
    store = spark.createDataFrame([(1, T("2026-10-12 12:00:00"), 1.0), (1, T("2026-10-01 12:00:00"), 9.0), (2, T("2026-10-12 12:00:00"), 2.0)], schema)
    new = spark.createDataFrame([(1, T("2026-10-12 12:00:00"), 1.5), (1, T("2026-10-12 12:01:00"), 1.6)], schema)
    merged = demand.merge_store(store, new)
    assert rows(merged.select("row_key", "surge_multiplier")) == [
        ("001#202610121200", 1.5), ("001#202610121201", 1.6), ("002#202610121200", 2.0)]
    assert rows(demand.merge_store(merged.drop("row_key"), new).select("row_key")) == rows(merged.select("row_key"))
    assert [r["surge_multiplier"] for r in demand.history(merged, 1, 60).collect()] == [1.5, 1.6]
    assert rows(demand.latest_rows(merged).select("zone_id", "surge_multiplier")) == [(1, 1.6), (2, 2.0)]


def test_utilisation_has_no_row_without_drivers(spark):
    w = spark.createDataFrame([(1, T("2026-10-12 12:00:00"), 2, 8)], "zone_id int, window_end timestamp, drivers_available int, drivers_on_trip int")
    assert demand.fleet_utilisation(w, "2026-10-12", 1).first()[0:3] == (0.8, True, 1)
    assert demand.fleet_utilisation(w, "2026-10-13").count() == 0


# ---- reconciliation --------------------------------------------------------

def test_batch_continuity(spark):
    def verdict(*sizes):
        df = spark.createDataFrame([(b, i) for b, n in sizes for i in range(n)], "batch_id int, i int")
        out = quality.batch_continuity(df, "batch_id", 2).collect()
        return any(r["gap_after"] for r in out), any(r["wrong_size"] for r in out)
    assert verdict((4, 2), (5, 2), (6, 2)) == (False, False)
    assert verdict((4, 2), (5, 2), (6, 2), (8, 2)) == (True, False)
    assert verdict((4, 2), (5, 1)) == (False, True)


@pytest.mark.parametrize("lost,twice,failed,ok", [(0, 0, 0, True), (2, 0, 0, False), (0, 3, 0, False), (0, 0, 2, False)])
def test_delivery_audit(spark, lost, twice, failed, ok):
    sent = [(0, i, f"e{i}") for i in range(1000 - lost)] + [(0, 1000 + i, f"e{i}") for i in range(twice)]
    archive = spark.createDataFrame(sent, "partition int, offset bigint, event_id string")
    assert quality.delivery_audit(archive, F.lit(1000), F.lit(failed)).first()["exactly_once"] is ok


def test_silver_and_layers(spark):
    raw = spark.createDataFrame([("a", "2026-10-12T12:00:00Z", 1), ("a", "2026-10-12T12:00:00Z", 1), ("b", "bad", 1),
                                 ("c", "2026-10-12T12:00:00Z", 41), ("d", "2026-10-12T12:00:00Z", 40)],
                                "event_id string, event_time string, zone_id int")
    assert rows(quality.silver_events(raw).select("event_id")) == [("a",), ("d",)]
    timed = raw.withColumn("event_time", F.try_to_timestamp("event_time"))
    assert quality.reconcile_layers(timed).first()[0:5] == (5, 1, 2, 2, True)


# ---- warehouse -------------------------------------------------------------

def test_star_schema(spark, tmp_path):
    t = spark.createDataFrame([trip(i, driver=f"D{i % 3}", request=f"2026-10-0{1 + i % 3} 08:0{i % 5}:00") for i in range(9)]
                              + [trip(99, fare="-1.00"), trip(98, driver="nobody")], TRIPS)
    drivers = spark.createDataFrame([(f"D{i}", f"Name {i}", "Auto", dt.date(2020, 1, 1), "C", 1, Decimal("4.50")) for i in range(3)], DRIVERS)
    zones = spark.createDataFrame([(i, f"Z{i}", "business", "s", 17.4, 78.4) for i in (10, 11)], CITY_ZONES)
    path = str(tmp_path / "dw")
    counts = dict(rows(warehouse.build(t, drivers, zones, path)))
    minutes = t.where("fare >= 0").select(F.date_trunc("minute", "request_time")).distinct().count()
    assert counts == {"dim_driver": 3, "dim_zone": 2, "dim_time": minutes, "fact_trips": 10}
    dim = spark.read.parquet(f"{path}/dim_driver")
    assert rows(dim.select("driver_key", "driver_id")) == [(1, "D0"), (2, "D1"), (3, "D2")]
    assert "name" not in dim.columns and len(dim.first()["name_hash"]) == 64
    fact = spark.read.parquet(f"{path}/fact_trips")
    assert fact.where("driver_key IS NULL").count() == 1
    first = fact.where("trip_id = 'T0'").first()
    assert (first["duration_min"], first["wait_time_min"], first["time_key"]) == (40.0, 5.0, 202610010800)

    warehouse.register(spark, path, "dw")
    one_day = spark.sql("SELECT count(*) AS n FROM dw.fact_trips WHERE trip_date = DATE '2026-10-02'")
    assert one_day.first()["n"] == 3
    plan = one_day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(trip_date" in plan
    bench = warehouse.bench_query(spark.table("dw.fact_trips"), "bench_q1", F.col("trip_date") == "2026-10-02")
    assert rows(bench) == [(10, 3)]
    spark.sql("DROP DATABASE dw CASCADE")


# ---- forecast --------------------------------------------------------------

def test_forecast(spark):
    start = dt.datetime(2026, 1, 5)
    rows_ = []
    for day in range(10):
        for b in range(48):
            level = 1 + (b % 12) // 4 + (2 if 16 <= b <= 40 else 0)
            for zone in (1, 2):
                rows_ += [(zone, start + dt.timedelta(days=day, minutes=30 * b, seconds=s)) for s in range(level * zone)]
    requests = spark.createDataFrame(rows_, "zone_id int, request_time timestamp")
    weather = spark.createDataFrame([(start + dt.timedelta(hours=h), 20.0 + h % 3, 0.5) for h in range(0, 100)],
                                    "hour_ts timestamp, temp_c double, rain_mm double")
    table = forecast.features(requests, weather, ["2026-01-06"]).cache()
    assert table.count() == 2 * 480
    assert table.where("is_holiday = 1").count() == 96
    assert table.where("bin >= '2026-01-10'").agg(F.max("temperature_c"), F.max("rain_mm_h")).first()[0:2] == (21.0, 0.0)
    assert forecast.complete(table).count() == 2 * (480 - 335 - 1)
    shares = dict(rows(forecast.time_split(forecast.complete(table)).groupBy("is_train").count()))
    assert 0.78 < shares[True] / sum(shares.values()) < 0.82
    trained = forecast.train(table, {"numTrees": 10, "maxDepth": 8, "minInstancesPerNode": 3, "seed": 42})
    assert set(trained.metrics) == {"linear_regression", "random_forest"} and trained.target_met
    assert trained.metrics[trained.name]["r2"] == max(m["r2"] for m in trained.metrics.values())
    scored = forecast.score(table, trained)
    assert scored.count() == 2 and scored.where("predicted_demand_next_30m < 0").count() == 0
    zones = zone_table(spark)
    one = forecast.forecast_for(scored, zones, 2).first()
    assert one["zone_name"] == "Zone 02" and one["recent_lag_30m"] == 6.0
    assert forecast.forecast_for(scored, zones, 39).count() == 0
    dry = forecast.features(requests)
    assert dry.agg(F.min("temperature_c"), F.max("rain_mm_h")).first()[0:2] == (28.0, 0.0)
    table.unpersist()

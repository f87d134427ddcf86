"""Joins, aggregates, dedup, series and layout on small frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from support import rows
from millrace.functions import bands, scalars, udfs
from millrace.functions.geo import CITY_BOX, haversine_km, in_box, make_zones, nearest_zone, zone_table
from millrace.functions.pricing import smooth_step
from millrace.operators import aggregates, dedup, joins, layout, series
from millrace.session import build_session, cached, shared_dir
from millrace.streaming.smoothing import smooth


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(
        [(1, "Alice", 101, 50000), (2, "Bob", 102, 60000), (3, "Charlie", 101, 70000),
         (4, "David", 103, 55000), (5, "Eve", 104, 65000), (6, "Frank", 102, 58000)],
        "id int, name string, dept int, salary int")


@pytest.fixture(scope="module")
def departments(spark):
    return spark.createDataFrame([(101, "IT"), (102, "HR"), (103, "Finance"), (104, "Marketing"), (105, "Operations")],
                                 "dept int, dept_name string")


@pytest.mark.parametrize("how,count", [("inner", 6), ("left", 6), ("right", 7), ("full", 7)])
def test_outer_joins(staff, departments, how, count):
    got = joins.hot_safe_join(staff, departments, ["dept"], how)
    want = staff.join(departments, "dept", how).select(got.columns)
    assert rows(got) == rows(want) and got.count() == count


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_outer_joins_with_null_and_repeated_keys(spark, how):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "w")], "k int, r string")
    got = joins.hot_safe_join(left, right, ["k"], how)
    assert rows(got) == rows(left.join(right, "k", how).select(got.columns))


def test_unknown_join_type(staff, departments):
    with pytest.raises(ValueError):
        joins.hot_safe_join(staff, departments, ["dept"], "sideways")


def test_departments_without_staff(staff, departments):
    assert rows(departments.join(staff, "dept", "left_anti")) == [(105, "Operations")]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_hot_keys_are_joined_apart(spark, how):
    left = spark.createDataFrame([(i % 3 if i % 2 else 50 + i, f"l{i}") for i in range(90)] + [(None, "n"), (7, "hot")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (51, "z"), (99, "q"), (None, "w")], "k int, r string")
    hot = joins.hot_keys(left, ["k"], 0.05).unionByName(spark.createDataFrame([(99,), (7,)], "k int"))
    assert {r["k"] for r in hot.collect()} == {0, 1, 2, 7, 99}
    got = joins.hot_safe_join(left, right, ["k"], how, hot)
    assert rows(got) == rows(left.join(right, "k", how).select(got.columns))


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_a_join_reads_each_side_once(spark, sf, how):
    orders = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey AS k", "o_totalprice")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey AS k", "l_quantity")
    plan = joins.hot_safe_join(orders, lines, ["k"], how)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 2


def test_the_join_is_chosen_by_size_at_run_time(spark, sf):
    """A table that is small only after its filter is broadcast, without a hint."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey", "l_quantity")
    names = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 500 = 0").selectExpr("o_orderkey AS l_orderkey", "o_orderpriority")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    try:
        out = joins.lookup_join(lines, names, "l_orderkey", "o_orderpriority", "none")
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString()
        out.collect()
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_fills_missing_and_null(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    out = df.select(joins.lookup(F.col("k"), {1: "Technology", 2: "Finance"}).alias("n"))
    assert [r["n"] for r in out.collect()] == ["Technology", "Unknown", "Unknown"]


def test_newest_reading_or_null(spark):
    df = spark.range(2)
    readings = spark.createDataFrame([("2026-01-01", 1.0), ("2026-01-02", 2.0)], "t string, rain double")
    assert [r["rain"] for r in joins.with_newest(df, readings, "t", ["rain"]).collect()] == [2.0, 2.0]
    assert [r["rain"] for r in joins.with_newest(df, readings.limit(0), "t", ["rain"]).collect()] == [None, None]


def test_salted_totals_equal_plain_totals(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("k"),
                                  (F.col("id") % 97).alias("v"))
    salted = aggregates.salted_agg(df, "k", "v", F.col("id"), 8, hot=F.col("k") == "hot")
    plain = df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").cast("double").alias("s"))
    assert rows(salted.select("k", "row_count", "total")) == rows(plain)


def test_lists_are_whole_and_bounded(spark):
    df = spark.range(2500).select((F.col("id") % 7 > 0).alias("k"), "id")
    lists = aggregates.chunked_lists(df, "k", "id", [("id", False)], chunk=100).collect()
    assert max(len(r["values"]) for r in lists) == 100
    hot = [v for r in sorted(lists, key=lambda r: r["part"]) if r["k"] for v in r["values"]]
    assert hot == [i for i in range(2500) if i % 7 > 0]


def test_counters_beside_a_job(spark):
    df, seen = aggregates.counted(spark.range(100), {"large": F.count_if(F.col("id") >= 90)}, "c1")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["large"] == 10


def test_top_is_held_to_twenty_and_metric_is_checked(spark):
    df = spark.range(50).withColumn("ratio", F.col("id") * 2)
    assert aggregates.top_by(df, "ratio", {"ratio": "ratio"}, "id", 99).count() == 20
    assert aggregates.top_by(df, "ratio", {"ratio": "ratio"}, "id", 0).collect()[0]["id"] == 49
    with pytest.raises(ValueError):
        aggregates.top_by(df, "price", {"ratio": "ratio"}, "id", 5)


def test_upsert_and_changed_since(spark):
    table = spark.createDataFrame([(1, "old", 10), (2, "keep", 10)], "k int, v string, m int")
    changes = spark.createDataFrame([(1, "new", 11), (3, "add", 12), (2, "stale", 5)], "k int, v string, m int")
    assert rows(dedup.upsert(table, changes, "k", "m").select("k", "v")) == [(1, "new"), (2, "keep"), (3, "add")]
    assert dedup.changed_since(changes, "m", 10).count() == 2
    assert dedup.changed_since(changes, "m", None).count() == 3


def test_bands(spark):
    df = spark.createDataFrame([(90,), (89,), (70,), (50,), (49,), (None,)], "m int")
    assert [r[0] for r in df.select(bands.grade_band(F.col("m"))).collect()] == ["A", "B", "C", "D", "F", "F"]
    pay = spark.createDataFrame([(2000.0,), (1999.0,)], "p double")
    assert [r[0] for r in pay.select(bands.payment_band(F.col("p"))).collect()] == ["HIGH", "NORMAL"]
    lower = spark.createDataFrame([(50000,)], "s int")
    assert lower.select(bands.salary_band(F.col("s")), bands.salary_band(F.col("s"), bands.SALARY_BANDS_LOW_MEDIUM)
                        ).first()[0:2] == ("Low", "Medium")


def test_udfs_equal_builtins_but_hide_the_filter(spark, sf):
    staff = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_acctbal").alias("salary"), (F.col("c_nationkey") % 10).alias("years"))
    money = staff.withColumn("salary", F.col("salary") * 10)
    assert rows(money.select("salary", udfs.salary_category("salary"))) == \
        rows(money.select("salary", bands.salary_band(F.col("salary"))))
    assert rows(money.select("salary", udfs.employee_grade("salary", "years"))) == \
        rows(money.select("salary", bands.joint_grade(F.col("salary"), F.col("years"))))
    builtin = layout.plan_text(money.where(bands.salary_band(F.col("salary")) == "High"))
    opaque = layout.plan_text(money.where(udfs.salary_category("salary") == "High"))
    assert "ArrowEvalPython" in opaque and "ArrowEvalPython" not in builtin


def test_billing_status_udf(spark):
    df = spark.createDataFrame([(0.0,), (5.0,)], "b double")
    assert [r[0] for r in df.select(udfs.billing_status("b")).collect()] == ["PAID", "DUE"]


def test_scalars(spark):
    df = spark.createDataFrame([("12.5",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(scalars.number_or_zero(F.col("t"))).collect()] == [12.5, 0.0, 0.0]
    assert [r[0] for r in df.select(scalars.miles_to_km(F.col("t"))).collect()] == [12.5 * 1.60934, None, None]
    one = spark.range(1)
    fare = one.select(scalars.tariff_fare(F.lit("Sedan"), F.lit(10.0), F.lit(1.5)),
                      scalars.tariff_fare(F.lit("Rocket"), F.lit(10.0), F.lit(1.5))).first()
    assert fare[0] == 337.5 and fare[1] is None
    key = one.select(scalars.store_key(F.lit(7), F.lit("2026-10-12 14:05:00").cast("timestamp"))).first()[0]
    assert key == "007#202610121405"
    assert one.select(scalars.matches_text(F.lit("Zone 07"), " ZONE 07")).first()[0] is True
    assert one.select(scalars.matches_text(F.lit("Zone 07"), "  ")).first()[0] is False
    assert one.select(F.current_timestamp().alias("t")).dtypes == [("t", "timestamp")]


def test_nearest_zone_by_brute_force(spark):
    import math
    random.seed(3)
    zones = make_zones()
    points = [(random.uniform(17.0, 17.9), random.uniform(78.0, 78.9)) for _ in range(200)]
    got = spark.createDataFrame(points, "lat double, lon double").select(
        nearest_zone(F.col("lat"), F.col("lon"), zones).alias("z")).collect()
    for (lat, lon), row in zip(points, got):
        best = min(zones, key=lambda z: ((z.lat - lat) ** 2 + ((z.lon - lon) * math.cos(math.radians(lat))) ** 2, z.zone_id))
        assert row["z"] == best.zone_id


def test_zones(spark):
    table = zone_table(spark)
    assert table.count() == 40 and table.agg(F.min("zone_id"), F.max("zone_id")).first()[0:2] == (1, 40)
    inside = table.where(in_box(F.col("latitude"), F.col("longitude"), CITY_BOX)).count()
    assert inside == 40
    same = spark.range(1).select(haversine_km(F.lit(17.4), F.lit(78.4), F.lit(17.4), F.lit(78.4))).first()[0]
    assert same == 0.0


def test_series(spark):
    start = dt.datetime(2026, 1, 1)
    counts = spark.createDataFrame([(1, start, 4), (1, start + dt.timedelta(hours=2), 6), (2, start + dt.timedelta(hours=1), 1)],
                                   "z int, bin timestamp, demand int")
    grid = series.time_grid(counts, "z", "bin", "demand", 1800)
    assert grid.count() == 10 and grid.agg(F.sum("demand")).first()[0] == 11.0
    lagged = series.with_lags(grid, "z", "bin", "demand", {"prev": 1, "next": -1}, 1800)
    out = series.with_rolling_means(lagged, "z", "bin", "demand", {"mean2": 2}, 1800).where("z = 1").orderBy("bin").collect()
    assert [r["prev"] for r in out] == [None, 4.0, 0.0, 0.0, 0.0]
    assert [r["next"] for r in out] == [0.0, 0.0, 0.0, 6.0, None]
    assert [r["mean2"] for r in out] == [None, 2.0, 0.0, 0.0, 3.0]


@pytest.mark.parametrize("chunk, linked", [(60, 64), (600, 64), (86400, 64), (60, 3), (120, 8), (600, 2)])
def test_step_limited_series_equals_a_loop(spark, chunk, linked, monkeypatch):
    """Chunks that settle and chunks that never do give the same as one long loop, in one round or in many."""
    monkeypatch.setattr(series, "LINKED", linked)
    random.seed(11)
    start, data = dt.datetime(2026, 1, 1), []
    for zone in (1, 2, 3):
        minute = 0
        for i in range(400):
            minute += random.choice([1, 1, 1, 2, 15]) if zone == 1 else 1
            # zone 3 alternates so that its chunks do not settle
            target = random.choice([1.0, 1.2, 1.5, 2.0, 2.5, 3.4]) if zone < 3 else (1.0 if i % 2 else 2.5)
            data.append((zone, start + dt.timedelta(minutes=minute), target))
    df = spark.createDataFrame(data, "z int, t timestamp, target double").repartition(6)
    got = series.step_limited(df, "z", "t", "target", "out", smooth_step, 600, 1.0, 3.0, chunk)
    want, last = [], {}
    for zone, t, target in sorted(data):
        at, value = last.get(zone, (None, None))
        value = smooth(target, value if at is not None and (t - at).total_seconds() <= 600 else None)
        last[zone] = (t, value)
        want.append((zone, t, target, value))
    assert rows(got) == sorted(want, key=repr)


def test_partitions(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")))
    assert layout.partition_count(layout.spread(df, 4)) == 4
    assert layout.partition_count(layout.shrink(layout.spread(df, 4), 2)) == 2
    assert layout.partition_profile(layout.spread(df, 4)).agg(F.sum("rows")).first()[0] == 1000
    plain = layout.partition_profile(layout.spread(df, 8, "k")).agg(F.max("rows")).first()[0]
    salted = layout.partition_profile(layout.salted_repartition(df, 8, "k", F.col("id"), 8, F.col("k") == "hot")
                                      ).agg(F.max("rows")).first()[0]
    assert salted < plain


def test_session(spark):
    assert build_session("again") is spark or build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert shared_dir(spark).endswith("shared")
    df = spark.range(5)
    with cached(df) as held:
        assert held.storageLevel.useMemory and held.count() == 5
    assert not df.storageLevel.useMemory


def test_schema_contract(spark):
    df = spark.range(1)
    assert layout.require_columns(df, [("id", "bigint")]).columns == ["id"]
    with pytest.raises(TypeError):
        layout.require_columns(df, [("id", "string")])
    layout.preview(df, 1)


def test_series_windows_over_many_chunks(spark, monkeypatch):
    """Lags and means across chunk borders equal a plain window, and no window holds a whole series."""
    monkeypatch.setattr(series, "CHUNK_STEPS", 16)
    grid = spark.range(400).selectExpr("id % 2 AS z", "timestamp_seconds(1700000000 - 1700000000 % 1800 + (id div 2) * 1800) AS bin",
                                       "CAST((id * 7919) % 31 AS double) AS demand")
    lags, sizes = {"y": -1, "a": 1, "b": 2, "c": 47}, {"m2": 2, "m4": 4}
    got = series.with_rolling_means(series.with_lags(grid, "z", "bin", "demand", lags, 1800), "z", "bin", "demand", sizes, 1800)
    grid.createOrReplaceTempView("series_input")
    want = spark.sql("""SELECT z, bin, demand, lead(demand) OVER w, lag(demand) OVER w, lag(demand, 2) OVER w, lag(demand, 47) OVER w,
        CASE WHEN row_number() OVER w >= 2 THEN avg(demand) OVER (PARTITION BY z ORDER BY bin ROWS 1 PRECEDING) END,
        CASE WHEN row_number() OVER w >= 4 THEN avg(demand) OVER (PARTITION BY z ORDER BY bin ROWS 3 PRECEDING) END
        FROM series_input WINDOW w AS (PARTITION BY z ORDER BY bin)""")
    assert rows(got) == rows(want)


def test_names_are_resolved_by_id_or_any_part(spark):
    names = spark.createDataFrame([(3, "Airport Road"), (1, "Old Airport"), (2, "Lake View"), (12, "Gate 2")], "id bigint, name string")
    terms = ["airport", " LAKE ", "ew", "e", "2", "99", "nowhere", "", None, "road"]
    got = {r["t"]: r["id"] for r in joins.resolved(spark.createDataFrame([(t,) for t in terms], "t string"), "t", names).collect()}
    assert got == {"airport": 1, " LAKE ": 2, "ew": 2, "e": 2, "2": 2, "99": None, "nowhere": None, "": None, None: None, "road": 3}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_a_hot_key_is_joined_in_pieces(spark, monkeypatch, how):
    """Like rows take few bytes, so AQE leaves them in one task; they are dealt by their number."""
    monkeypatch.setattr(joins, "PIECE", 100, raising=False)
    left = spark.range(4000, numPartitions=8).selectExpr("CASE WHEN id % 2 = 0 THEN -1 WHEN id % 5 = 0 THEN NULL ELSE id END AS k", "id % 3 AS v")
    right = spark.createDataFrame([(-1, "x"), (-1, "x"), (-1, "y"), (3, "z"), (None, "n"), (9999, "q")], "k bigint, w string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        for a, b in ((left, right), (right, left)):
            got = joins.hot_safe_join(a, b, ["k"], how, joins.hot_keys(left, ["k"]))
            assert rows(got) == rows(a.join(b, "k", how).select(got.columns))
            placed = got.where("k = -1").groupBy(F.spark_partition_id().alias("p")).count().agg(F.count("*"), F.max("count")).first()
            assert placed[0] >= 3 and placed[1] < 6000
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)

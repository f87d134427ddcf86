"""Readers, writers, imports and the catalog."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from support import rows
from millrace.operators.layout import plan_text
from millrace.sinks import files as sinks
from millrace.sinks.streams import as_messages
from millrace.sources import batch, catalog, incremental
from millrace.tables import CLICKSTREAM, EMPLOYEES, LOG_LINES, read


def test_text_and_words(spark, tmp_path):
    (tmp_path / "t.txt").write_text("spark is fast\nspark is fun\n")
    lines = batch.text_lines(spark, str(tmp_path / "t.txt"))
    words = lines.select(F.explode(F.split("value", " ")).alias("w")).groupBy("w").count()
    assert rows(words) == [("fast", 1), ("fun", 1), ("is", 2), ("spark", 2)]


def test_csv(spark, tmp_path):
    (tmp_path / "e.csv").write_text("EmployeeID,Name,Department,Salary,Experience\n1,Ann,IT,100,3\n")
    path = str(tmp_path / "e.csv")
    assert batch.csv_table(spark, path, EMPLOYEES).dtypes == batch.csv_table(spark, path, None).dtypes
    assert batch.csv_table(spark, path, EMPLOYEES).first()["Name"] == "Ann"


def test_log_without_header(spark, tmp_path):
    (tmp_path / "l.log").write_text("2026-01-01 10:00:00,ERROR,1.1.1.1,/a,500,900\n")
    assert batch.delimited_log(spark, str(tmp_path / "l.log"), LOG_LINES).first()["response_time"] == 900


def test_permissive_text_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a,b,c\n1,2,3\n1,2\n1,2,3,4\n")
    got = batch.csv_as_text(spark, str(tmp_path / "d.csv"), ["a", "b", "c"])
    assert rows(got) == [("1", "2", "3"), ("1", "2", "3"), ("1", "2", None)]


def test_literal_and_generated_rows(spark):
    assert batch.rows_table(spark, [(1, "a")], "id int, n string").toDF("x", "y").columns == ["x", "y"]
    made = batch.generated(spark, 1, 1000, {"dept": F.col("id") % 5, "salary": F.lit(30000) + F.col("id") % 100}, 4)
    assert made.rdd.getNumPartitions() == 4 and made.agg(F.count("*"), F.max("id")).first()[0:2] == (1000, 1000)


def test_json_and_empty_table(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"event_id": "1", "event_time": "2026-01-01T00:00:00Z"}\n')
    assert batch.json_table(spark, str(tmp_path / "a.json"), CLICKSTREAM).first()["event_time"] == dt.datetime(2026, 1, 1)
    assert batch.parquet_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


def test_newest_reading(spark):
    r = spark.createDataFrame([("2026-01-01T00:00:00Z", 1.0), ("2026-01-02T00:00:00Z", 2.0)], "event_time string, rain double")
    assert batch.newest_reading(r).first()["rain"] == 2.0 and batch.newest_reading(r.limit(0)).count() == 0


def test_jdbc_options():
    options = batch.jdbc_options("jdbc:x", "trips", "u", "p", "drv", "trip_id", 0, 100, 8)
    assert options["numPartitions"] == "8" and options["lowerBound"] == "0" and options["user"] == "u"
    assert "partitionColumn" not in batch.jdbc_options("jdbc:x", "trips")
    with pytest.raises(ValueError):
        batch.jdbc_options("jdbc:x", "trips", column="id")


def test_naive_times_are_utc_and_scans_are_pruned(spark, sf):
    assert dict(read(spark, sf, "events").dtypes)["ts"] == "timestamp"
    plan = plan_text(read(spark, sf, "orders").where(F.col("o_totalprice") > 400000).select("o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThan(o_totalprice,400000.0)" in plan
    with pytest.raises(ValueError):
        read(spark, sf, "secrets")


def test_reports_and_partitioned_files(spark, tmp_path, sf):
    df = spark.createDataFrame([(1, "IT"), (2, "HR"), (3, "IT")], "id int, dept string").repartition(3)
    sinks.report_csv(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    sinks.report_csv(df.repartition(3), str(tmp_path / "many"), files=None)
    assert len(list((tmp_path / "many").glob("*.csv"))) > 1
    sinks.partitioned_csv(df, str(tmp_path / "parts"), "dept")
    sinks.clustered_csv(df, str(tmp_path / "clustered"), "dept")
    for folder in ("parts", "clustered"):
        assert {p.name for p in (tmp_path / folder).glob("dept=*")} == {"dept=IT", "dept=HR"}
    assert len(list((tmp_path / "clustered" / "dept=IT").glob("*.csv"))) == 1
    sinks.parquet_tables({"a": df, "b": df.limit(1)}, str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables" / "b")).count() == 1


def test_partition_pruning_saves_bytes(spark, tmp_path, sf):
    orders = read(spark, sf, "orders").withColumn("city", F.lit("c"))
    path = str(tmp_path / "p")
    sinks.partitioned_parquet(orders, path, ["city", "o_orderstatus"])
    one = spark.read.parquet(path).where("city = 'c' AND o_orderstatus = 'P'")
    assert sinks.scanned_bytes(one) < sinks.scanned_bytes(spark.read.parquet(path)) / 2
    sinks.csv_copy(orders, str(tmp_path / "csv"))
    header = next(iter(Path(tmp_path / "csv").glob("*.csv"))).read_text().splitlines()[0]
    assert "city" not in header and "o_orderkey" in header


def test_messages(spark):
    row = as_messages(spark.createDataFrame([(7, "a")], "k int, v string"), "k").first()
    assert (row["key"], row["value"]) == ("7", '{"k":7,"v":"a"}')


def test_imports(spark, tmp_path):
    table = str(tmp_path / "trips")
    schema = "trip_id int, status string, last_modified timestamp"
    t = lambda d: dt.datetime(2026, 1, d)
    with pytest.raises(FileNotFoundError):
        incremental.read_version(spark, table)
    first = spark.createDataFrame([(1, "OPEN", t(1)), (2, "OPEN", t(2))], schema)
    assert incremental.import_changes(spark, first, table, "trip_id", "last_modified") == 1
    later = spark.createDataFrame([(1, "DONE", t(3)), (2, "STALE", t(1)), (3, "OPEN", t(4))], schema)
    assert incremental.import_changes(spark, later, table, "trip_id", "last_modified") == 2
    assert rows(incremental.read_version(spark, table).select("trip_id", "status")) == [(1, "DONE"), (2, "OPEN"), (3, "OPEN")]
    assert rows(incremental.read_version(spark, table, 1).select("trip_id", "status")) == [(1, "OPEN"), (2, "OPEN")]
    assert incremental.import_changes(spark, later, table, "trip_id", "last_modified") == 3  # nothing new, same rows
    assert incremental.read_version(spark, table).count() == 3
    assert incremental.current_version(spark, table) == (3, t(4))
    incremental.full_refresh({"zones": first}, str(tmp_path / "dims"), files=1)
    incremental.full_refresh({"zones": later}, str(tmp_path / "dims"), files=1)
    assert spark.read.parquet(str(tmp_path / "dims" / "zones")).count() == 3


@pytest.mark.parametrize("buckets", [1, 2, 3, 5, 8, 13, 64, 100])
def test_a_new_bucket_takes_rows_from_one_old(spark, buckets):
    df = spark.range(5000)
    more = rows(df.select(incremental.bucket_of("id", buckets).alias("a"), incremental.bucket_of("id", 2 * buckets + 3).alias("b")).distinct())
    assert {a for a, _ in more} == set(range(buckets)) and {b for _, b in more} <= set(range(2 * buckets + 3))
    assert all(incremental.split_from(b, buckets) == a for a, b in more)


def test_buckets_grow_with_a_table(spark, tmp_path):
    """From 300 to 30,000 rows: bucket sizes stay near one another, and an import leaves other buckets where they lie."""
    table, start = str(tmp_path / "grown"), dt.datetime(2026, 1, 1)
    source = lambda n: spark.range(n).select(
        F.col("id").cast("string").alias("k"), (F.lit(start) + F.expr("make_dt_interval(0, 0, 0, id)")).alias("m"))
    for n in (300, 400, 3000, 20_000, 30_000):
        incremental.import_changes(spark, source(n), table, "k", "m", bucket_rows=150)
        sizes = incremental.bucket_sizes(spark, table)
        assert sum(sizes.values()) == n and len(sizes) == -(-n // 150)
        assert 150 / 4 <= min(sizes.values()) and max(sizes.values()) <= 150 * 2
    folders = lambda: incremental._commit(spark, table)["folders"]
    before = folders()
    one = spark.createDataFrame([("7", start + dt.timedelta(days=9))], "k string, m timestamp")
    incremental.import_changes(spark, one, table, "k", "m", bucket_rows=150)
    after = folders()
    # One changed key: its bucket and at most the one that is split are written again.
    assert sum(after.get(b) != v for b, v in before.items()) <= 2 and set(before) <= set(after)
    got = incremental.read_version(spark, table)
    assert got.count() == 30_000 == got.select("k").distinct().count()
    assert got.where("k = '7'").first()["m"] == start + dt.timedelta(days=9)
    assert incremental.read_version(spark, table, 3).count() == 3000


def test_commits_without_a_number_of_buckets(spark, tmp_path):
    """A table of 64 buckets, as imports used to write it, goes on growing from there."""
    table, day = str(tmp_path / "older"), dt.datetime(2026, 1, 1)
    old = spark.range(200).select(F.col("id").alias("k"), F.lit(day).alias("m"))
    (old.withColumn("_bucket", F.pmod(F.xxhash64("k"), F.lit(64)).cast("int"))
     .write.partitionBy("_bucket").parquet(f"{table}/data/v1"))
    folders = {r["_bucket"]: 1 for r in spark.read.parquet(f"{table}/data/v1").select("_bucket").distinct().collect()}
    spark.createDataFrame([(1, day, folders, old.schema.json())], "version bigint, high_water timestamp, folders map<int, bigint>, schema string"
                          ).write.parquet(f"{table}/commits")
    more = spark.range(190, 2000).select(F.col("id").alias("k"), F.lit(day + dt.timedelta(days=1)).alias("m"))
    incremental.import_changes(spark, more, table, "k", "m", bucket_rows=20)
    got = incremental.read_version(spark, table)
    assert (got.count(), got.select("k").distinct().count(), got.agg(F.count_if(F.col("m") > day)).first()[0]) == (2000, 2000, 1810)


def test_repair_finds_new_partitions(spark, tmp_path):
    path = str(tmp_path / "ext")
    df = spark.createDataFrame([(1, "a")], "id int, p string")
    df.write.partitionBy("p").parquet(path)
    catalog.register_external(spark, "ext_table", path, ["p"])
    df.withColumn("p", F.lit("b")).write.mode("append").partitionBy("p").parquet(path)
    assert spark.table("ext_table").count() == 1
    catalog.repair(spark, "ext_table")
    assert spark.table("ext_table").count() == 2
    catalog.as_view(df, "a_view")
    assert spark.sql("SELECT count(*) FROM a_view").first()[0] == 1
    spark.sql("DROP TABLE ext_table")


def test_partitioned_files_are_dealt_without_a_sort(spark, tmp_path, monkeypatch):
    """Beyond 200 partitions a shuffle would sort its rows in the map tasks, and spill them where they are many."""
    plans, deal = [], sinks.by_value
    monkeypatch.setattr(sinks, "by_value", lambda df, *columns: (plans.append(plan_text(deal(df, *columns))), deal(df, *columns))[1])
    df = spark.range(300).selectExpr("id", "IF(id % 4 = 3, NULL, id % 4) AS kind")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "600")
        sinks.partitioned_parquet(df, str(tmp_path / "parquet"), ["kind"])
        sinks.clustered_csv(df, str(tmp_path / "csv"), "kind")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(plans) == 2 and all(", 200), REBALANCE" in p for p in plans)
    for back in (spark.read.parquet(str(tmp_path / "parquet")), spark.read.csv(str(tmp_path / "csv"), header=True)):
        assert rows(back.selectExpr("CAST(id AS bigint)", "CAST(kind AS bigint)")) == rows(df)

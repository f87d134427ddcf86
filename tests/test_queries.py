"""Every named query against its SQL, and the contract of the entry module."""

import duckdb
import pytest

import __spark_entry__ as entry
from support import SMALL
from scripts.check import rows_of
from millrace.queries import QUERIES, SQL
from millrace.tables import TABLES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SMALL)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_approximate_counts_are_close(spark):
    from pyspark.sql import functions as F
    pairs = spark.range(200_000).select((F.col("id") % 4).alias("k"), (F.xxhash64("id") % 30_000).alias("user"))
    for row in pairs.groupBy("k").agg(F.count_distinct("user").alias("exact"),
                                      F.approx_count_distinct("user", 0.01).alias("guess")).collect():
        assert abs(row["guess"] - row["exact"]) <= 0.03 * row["exact"]


def test_no_user_carries_a_sketch_of_its_own(spark, tmp_path):
    rows = [("view", i % 40) for i in range(200)] + [("click", None)] * 5 + [(None, 3), (None, 4), (None, None), ("click", 7), ("only null", None)]
    spark.createDataFrame(rows, "event_type string, user_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["approx_distinct"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    per_user = [line for line in plan.splitlines() if "user_id" in line.partition("keys=[")[2].partition("]")[0]]
    assert per_user and not any("approx" in line for line in per_user)
    assert {tuple(r) for r in found.collect()} == {("view", 40, True), ("click", 1, True), (None, 2, True), ("only null", 0, True)}

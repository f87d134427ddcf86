"""Projection, filter, banding, text and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.functions.bands import (experience_band, grade_band, joint_grade, risk_band, salary_band)
from millrace.operators.aggregates import total
from millrace.operators.dedup import dedup_latest, upsert
from millrace.operators.layout import partition_profile
from millrace.plans import mapping
from millrace.queries.registry import big, query
from millrace.queries.views import UNIFIED, TRIPS, with_
from millrace.streaming.alerts import card_alerts, threshold_alerts
from millrace.tables import read


def employees(spark, d):
    """Customers as employees: account balance x 10 is the salary."""
    return read(spark, d, "customer").select(
        F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"), (F.col("c_acctbal") * 10).alias("salary"),
        (F.col("c_nationkey") % 10).alias("experience"))


EMPLOYEES = """
employees AS (SELECT c_custkey AS employee_id, c_name AS name, c_mktsegment AS department,
                     c_acctbal * 10 AS salary, c_nationkey % 10 AS experience FROM customer)"""


@query("scan_parquet_count", "SELECT count(*) AS row_count FROM lineitem")
def scan_parquet_count(spark, d):
    return read(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query("range_derived", """
SELECT id % 5 AS department_id, count(*) AS row_count, sum(salary) AS salary_sum
FROM (SELECT o_orderkey * 8 + n AS id, 30000 + (o_orderkey * 8 + n) % 50000 AS salary
      FROM orders, range(1, 9) AS r(n)) GROUP BY 1""")
def range_derived(spark, d):
    """Eight generated ids per order, each with derived columns."""
    numbered = read(spark, d, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("n"))
    ids = numbered.select((F.col("o_orderkey") * 8 + F.col("n")).alias("id"))
    rows = ids.select((F.col("id") % 5).alias("department_id"), (F.lit(30000) + F.col("id") % 50000).alias("salary"))
    return rows.groupBy("department_id").agg(F.count(F.lit(1)).alias("row_count"),
                                             F.sum("salary").alias("salary_sum"))


@query("project_columns", "SELECT c_name AS name, c_acctbal AS salary FROM customer")
def project_columns(spark, d):
    return read(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("salary"))


@query("bonus_column", "SELECT c_custkey, c_acctbal * CAST(0.10 AS DOUBLE) AS bonus FROM customer")
def bonus_column(spark, d):
    return (read(spark, d, "customer").withColumn("bonus", F.col("c_acctbal") * 0.10)
            .select("c_custkey", "bonus"))


@query("filter_numeric", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 60000")
def filter_numeric(spark, d):
    return (read(spark, d, "lineitem").where(F.col("l_extendedprice") > 60000)
            .select("l_orderkey", "l_linenumber", "l_extendedprice"))


@query("filter_string", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_string(spark, d):
    return read(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query("filter_compound", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND (o_totalprice > 300000 OR o_orderpriority = '1-URGENT')""")
def filter_compound(spark, d):
    wanted = (F.col("o_orderstatus") == "F") & (
        (F.col("o_totalprice") > 300000) | (F.col("o_orderpriority") == "1-URGENT"))
    return read(spark, d, "orders").where(wanted).select("o_orderkey", "o_totalprice")


@query("filter_notnull_events", """
SELECT event_id, event_type, value FROM events
WHERE event_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL""")
def filter_notnull_events(spark, d):
    from millrace.streaming.windows import usable_events

    return (usable_events(read(spark, d, "events"), "event_id", "ts", "event_type")
            .where(F.col("value").isNotNull()).select("event_id", "event_type", "value"))


@query("salary_bands", "WITH" + EMPLOYEES + """
SELECT employee_id, CASE WHEN salary >= 65000 THEN 'High' WHEN salary >= 55000 THEN 'Medium' ELSE 'Low' END AS salary_category
FROM employees""")
def salary_bands(spark, d):
    return employees(spark, d).select("employee_id", salary_band(F.col("salary")).alias("salary_category"))


@query("grade_bands", """
SELECT p_partkey, CASE WHEN m >= 90 THEN 'A' WHEN m >= 80 THEN 'B' WHEN m >= 70 THEN 'C' WHEN m >= 50 THEN 'D' ELSE 'F' END AS grade
FROM (SELECT p_partkey, p_size * 2 AS m FROM part)""")
def grade_bands(spark, d):
    return read(spark, d, "part").select("p_partkey", grade_band(F.col("p_size") * 2).alias("grade"))


@query("risk_levels", """
SELECT o_orderkey, CASE WHEN a >= 10000 THEN 'HIGH_RISK' WHEN a >= 5000 THEN 'SUSPICIOUS' ELSE 'NORMAL' END AS risk_level
FROM (SELECT o_orderkey, o_totalprice / 20 AS a FROM orders)""")
def risk_levels(spark, d):
    return read(spark, d, "orders").select("o_orderkey", risk_band(F.col("o_totalprice") / 20).alias("risk_level"))


@query("band_counts", "WITH" + EMPLOYEES + """
SELECT CASE WHEN salary >= 65000 THEN 'High' WHEN salary >= 55000 THEN 'Medium' ELSE 'Low' END AS salary_category,
       count(*) AS row_count FROM employees GROUP BY 1""")
def band_counts(spark, d):
    return (employees(spark, d).groupBy(salary_band(F.col("salary")).alias("salary_category"))
            .agg(F.count(F.lit(1)).alias("row_count")))


@query("square_column", "SELECT o_orderkey, o_custkey * o_custkey AS squared FROM orders")
def square_column(spark, d):
    return read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") * F.col("o_custkey")).alias("squared"))


@query("filter_even", "SELECT o_orderkey FROM orders WHERE o_custkey % 2 = 0")
def filter_even(spark, d):
    return read(spark, d, "orders").where(F.col("o_custkey") % 2 == 0).select("o_orderkey")


@query("word_explode_count", """
SELECT word, count(*) AS occurrences FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def word_explode_count(spark, d):
    words = read(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))


@query("row_format", """
SELECT c_custkey, 'Employee: ' || c_name || ' | Department: ' || c_mktsegment AS line FROM customer""")
def row_format(spark, d):
    line = F.concat(F.lit("Employee: "), "c_name", F.lit(" | Department: "), "c_mktsegment")
    return read(spark, d, "customer").select("c_custkey", line.alias("line"))


@query("json_flatten", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(spark, d):
    parsed = read(spark, d, "events").select("event_id", F.from_json("props", "k bigint").alias("data"))
    return parsed.select("event_id", "data.*")


@query("to_json_publish", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def to_json_publish(spark, d):
    """Messages of key and JSON value, read back as a consumer would."""
    from millrace.sinks.streams import as_messages

    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return as_messages(orders, "o_orderkey").select("key", F.from_json("value", orders.schema).alias("v")).select("key", "v.*")


@query("partition_profile", """
SELECT count(*) AS total_rows, true AS in_eight_partitions, true AS largest_below_twice_the_mean FROM lineitem""")
def partition_profile_query(spark, d):
    """Rows per partition after a repartition by key: all are there, and no partition has twice the mean."""
    sizes = partition_profile(read(spark, d, "lineitem").repartition(8, "l_orderkey"))
    return sizes.agg(F.sum("rows").alias("total_rows"), (F.count(F.lit(1)) == 8).alias("in_eight_partitions"),
                     (F.max("rows") < 2 * F.avg("rows")).alias("largest_below_twice_the_mean"))


AMOUNT = "CAST(floor(o_totalprice / 20) AS BIGINT)"


@query("alert_messages", f"""
SELECT 'HIGH_RISK' AS alert_level,
       '🚨 HIGH-RISK ALERT | Transaction: ' || o_orderkey || ' | Employee: ' || o_custkey
       || ' | Department: ' || o_orderpriority || ' | Amount: ₹' || {AMOUNT} AS alert_message
FROM orders WHERE {AMOUNT} >= 10000""")
def alert_messages(spark, d):
    rows = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("transactionId"), F.col("o_custkey").alias("employeeId"),
        F.col("o_orderpriority").alias("department"), big(F.floor(F.col("o_totalprice") / 20)).alias("amount"))
    return threshold_alerts(rows).toDF("alert_level", "alert_message")


@query("fraud_alerts", """
SELECT o_orderkey AS transaction_id, o_custkey AS account_id, o_totalprice AS amount, international AS is_international,
       CASE WHEN o_totalprice >= 100000 THEN 'HIGH_VALUE' ELSE 'INTERNATIONAL' END AS alert_reason
FROM (SELECT *, CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey % 7 = 0 END AS international FROM orders)
WHERE o_totalprice IS NOT NULL AND (o_totalprice >= 100000 OR coalesce(international, false))""")
def fraud_alerts(spark, d):
    key = F.col("o_custkey")
    rows = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), key.alias("account_id"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("merchant"), F.col("o_orderstatus").alias("country"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(key % 7 == 0).alias("is_international"))
    return card_alerts(rows).select("transaction_id", "account_id", "amount", "is_international", "alert_reason")


# ---- sets and duplicates ---------------------------------------------------

@query("unified_events", with_(UNIFIED) + """
SELECT event_id, event_time, zone_id, kind, driver_id, status FROM unified
WHERE zone_id IS NOT NULL AND event_time IS NOT NULL""")
def unified_events(spark, d):
    return mapping.unified(spark, d).withColumn("zone_id", big("zone_id"))


@query("distinct_minutes", with_(TRIPS) + "SELECT DISTINCT date_trunc('minute', request_time) AS full_ts FROM trips")
def distinct_minutes(spark, d):
    return mapping.trips(spark, d).select(F.date_trunc("minute", "request_time").alias("full_ts")).distinct()


@query("dedup_by_key", """
SELECT event_id, event_type, value, version FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY version DESC) AS rn
  FROM (SELECT event_id, event_type, value, 1 AS version FROM events
        UNION ALL SELECT event_id, event_type, value + 1, 2 FROM events WHERE event_type = 'click'))
WHERE rn = 1""")
def dedup_by_key(spark, d):
    """Clicks arrive twice, the second time corrected."""
    ev = read(spark, d, "events").select("event_id", "event_type", "value")
    again = (ev.where(F.col("event_type") == "click")
             .withColumns({"value": F.col("value") + 1, "version": F.lit(2)}))
    return dedup_latest(ev.withColumn("version", F.lit(1)).unionByName(again), ["event_id"], [F.desc("version")])


@query("incremental_upsert", """
WITH mark AS (SELECT max(o_orderdate) - INTERVAL 365 DAY AS high_water FROM orders),
both_sides AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS last_modified, 0 AS change FROM orders
  UNION ALL
  SELECT o_orderkey, 'X', o_totalprice + 1, o_orderdate + INTERVAL 1 DAY, 1 FROM orders, mark
  WHERE o_orderdate + INTERVAL 1 DAY > high_water)
SELECT o_orderkey, o_orderstatus, o_totalprice, last_modified FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY last_modified DESC, change DESC) AS rn FROM both_sides)
WHERE rn = 1""")
def incremental_upsert(spark, d):
    """Orders of the last year come in again, changed, and replace their old rows."""
    table = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                            F.col("o_orderdate").alias("last_modified"))
    high_water = table.agg((F.max("last_modified") - F.expr("INTERVAL 365 DAY")).alias("m")).scalar()
    source = table.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1,
                                "last_modified": F.col("last_modified") + F.expr("INTERVAL 1 DAY")})
    return upsert(table, source.where(F.col("last_modified") > high_water), "o_orderkey", "last_modified")


# ---- user-defined functions ------------------------------------------------

@query("udf_band", "WITH" + EMPLOYEES + """
SELECT employee_id, CASE WHEN salary >= 65000 THEN 'High' WHEN salary >= 55000 THEN 'Medium' ELSE 'Low' END AS salary_category,
       CASE WHEN experience >= 7 THEN 'Senior' WHEN experience >= 4 THEN 'Mid-Level' ELSE 'Junior' END AS level,
       salary * CAST(0.10 AS DOUBLE) AS bonus FROM employees""")
def udf_band(spark, d):
    return employees(spark, d).select(
        "employee_id", udfs.salary_category("salary").alias("salary_category"),
        udfs.experience_level("experience").alias("level"), udfs.bonus("salary").alias("bonus"))


GRADE = """CASE WHEN salary >= 65000 AND experience >= 7 THEN 'A'
                WHEN salary >= 55000 AND experience >= 4 THEN 'B' ELSE 'C' END"""


@query("udf_grade", "WITH" + EMPLOYEES + f"""
SELECT employee_id, {GRADE} AS grade,
       name || ' works in ' || department || ' with ' || experience || ' years experience' AS description
FROM employees""")
def udf_grade(spark, d):
    return employees(spark, d).select("employee_id", udfs.employee_grade("salary", "experience").alias("grade"),
                                      udfs.describe("name", "department", "experience").alias("description"))


@query("udf_sql", "WITH" + EMPLOYEES + """
SELECT name, salary, CASE WHEN salary >= 65000 THEN 'High' WHEN salary >= 55000 THEN 'Medium' ELSE 'Low' END AS salary_category
FROM employees""")
def udf_sql(spark, d):
    udfs.register(spark)
    employees(spark, d).createOrReplaceTempView("employees_view")
    return spark.sql("SELECT name, salary, salary_category_sql(salary) AS salary_category FROM employees_view")


@query("udf_grade_agg", "WITH" + EMPLOYEES + f"""
SELECT {GRADE} AS grade, count(*) AS row_count,
       CAST(sum(CAST(salary AS DECIMAL(18,2))) AS DOUBLE) AS salary_sum FROM employees GROUP BY 1""")
def udf_grade_agg(spark, d):
    rows = employees(spark, d).select(udfs.employee_grade("salary", "experience").alias("grade"), "salary")
    return rows.groupBy("grade").agg(F.count(F.lit(1)).alias("row_count"), total("salary").alias("salary_sum"))


@query("builtin_grade", "WITH" + EMPLOYEES + f"""
SELECT employee_id, {GRADE} AS grade,
       CASE WHEN experience >= 7 THEN 'Senior' WHEN experience >= 4 THEN 'Mid-Level' ELSE 'Junior' END AS level
FROM employees""")
def builtin_grade(spark, d):
    """The same rules as the UDF queries, as built-in expressions."""
    return employees(spark, d).select("employee_id", joint_grade(F.col("salary"), F.col("experience")).alias("grade"),
                                      experience_band(F.col("experience")).alias("level"))

"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.geo import zone_table
from millrace.operators.aggregates import total
from millrace.operators.joins import hot_keys, hot_safe_join, lookup, lookup_join, with_newest, zero_filled
from millrace.operators.layout import require_columns
from millrace.plans import billing, mapping
from millrace.queries.registry import big, query
from millrace.queries.views import REQUESTS, ZONES, with_
from millrace.tables import BILLING_RECORD, read

# Lines stand 100 order keys further on, so that both sides have rows without a match.
SHIFT = 100


def _sides(spark, d):
    orders = read(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"), "o_totalprice")
    lines = read(spark, d, "lineitem").select((F.col("l_orderkey") + SHIFT).alias("order_key"), "l_partkey", "l_quantity")
    return orders, lines


_SIDES = f"""WITH u AS (SELECT o_orderkey AS order_key, o_totalprice FROM orders),
r AS (SELECT l_orderkey + {SHIFT} AS order_key, l_partkey, l_quantity FROM lineitem)
"""


@query("join_inner", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner(spark, d):
    c, n = read(spark, d, "customer"), read(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "c_name", "n_name")


@query("join_left", _SIDES + "SELECT order_key, o_totalprice, l_partkey, l_quantity FROM u LEFT JOIN r USING (order_key)")
def join_left(spark, d):
    return hot_safe_join(*_sides(spark, d), ["order_key"], "left")


@query("join_right", _SIDES + "SELECT order_key, o_totalprice, l_partkey, l_quantity FROM u RIGHT JOIN r USING (order_key)")
def join_right(spark, d):
    return hot_safe_join(*_sides(spark, d), ["order_key"], "right")


@query("join_full", _SIDES + """
SELECT coalesce(u.order_key, r.order_key) AS order_key, o_totalprice, l_partkey, l_quantity
FROM u FULL JOIN r ON u.order_key = r.order_key""")
def join_full(spark, d):
    return hot_safe_join(*_sides(spark, d), ["order_key"], "full")


@query("join_hot_keys", _SIDES + """
SELECT account < 0 AS is_hot, count(*) AS row_count, count(o_totalprice) AS orders, count(l_quantity) AS lines
FROM (SELECT coalesce(a.account, b.account) AS account, o_totalprice, l_quantity
      FROM (SELECT CASE order_key WHEN 1 THEN -1 WHEN 2 THEN -2 ELSE order_key END AS account, o_totalprice FROM u) a
      FULL JOIN (SELECT CASE WHEN order_key % 3 = 0 THEN -1 WHEN order_key % 7 = 0 THEN -3 ELSE order_key END AS account,
                        l_quantity FROM r) b ON a.account = b.account) GROUP BY 1""")
def join_hot_keys(spark, d):
    """A full join of rows in which one key holds a third of a side: hot keys are measured and joined apart."""
    orders, lines = _sides(spark, d)
    key = F.col("order_key")
    left = orders.select(F.when(key == 1, -1).when(key == 2, -2).otherwise(key).alias("account"), "o_totalprice")
    right = lines.select(F.when(key % 3 == 0, -1).when(key % 7 == 0, -3).otherwise(key).alias("account"), "l_quantity")
    joined = hot_safe_join(left, right, ["account"], "full", hot_keys(right, ["account"]))
    return joined.groupBy((F.col("account") < 0).alias("is_hot")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("o_totalprice").alias("orders"), F.count("l_quantity").alias("lines"))


@query("join_anti", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_anti(spark, d):
    """Orders without a line; the line side is reduced to its keys first."""
    keys = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return read(spark, d, "orders").join(keys, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query("join_broadcast", """
SELECT l_orderkey, l_linenumber, n_name, r_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_broadcast(spark, d):
    """Every line with its supplier's place; nations and regions are fixed lists, hence the hint."""
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    places = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    suppliers = read(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    return (read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").join(suppliers, "l_suppkey")
            .join(F.broadcast(places), "n_nationkey").select("l_orderkey", "l_linenumber", "n_name", "r_name"))


@query("join_filter_sort", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice > 400000 ORDER BY o_totalprice DESC, o_orderkey""")
def join_filter_sort(spark, d):
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey).where(F.col("o_totalprice") > 400000)
            .select("o_orderkey", "c_name", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey"))


@query("join_group", """
SELECT n_name, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def join_group(spark, d):
    """Aggregated by the join key first, so the join sees one row per nation."""
    per_nation = (read(spark, d, "customer").groupBy("c_nationkey")
                  .agg(F.count(F.lit(1)).alias("customers"), total("c_acctbal").alias("total_balance")))
    return (per_nation.join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("n_name", "customers", "total_balance",
                    (F.col("total_balance") / F.col("customers")).alias("mean_balance")))


# ---- billing ---------------------------------------------------------------

# Cover in percent by segment; MACHINERY has none.
COVER = {"AUTOMOBILE": 90.0, "BUILDING": 80.0, "FURNITURE": 60.0, "HOUSEHOLD": 50.0}


def _billing(spark, d):
    customers = read(spark, d, "customer")
    visits = (read(spark, d, "orders")
              .select(F.col("o_orderkey").alias("visit_id"), F.col("o_custkey").alias("patient_id"),
                      F.col("o_orderpriority").alias("department")))
    lines = read(spark, d, "lineitem")
    procedures = lines.select(F.col("l_orderkey").alias("visit_id"), F.col("l_extendedprice").alias("procedure_cost"))
    payments = (lines.where(F.col("l_returnflag") == "A")
                .select(F.col("l_orderkey").alias("visit_id"), F.col("l_extendedprice").alias("payment_amount")))
    insurance = (customers.where(F.col("c_mktsegment").isin(*COVER))
                 .select(F.col("c_custkey").alias("patient_id"),
                         lookup(F.col("c_mktsegment"), COVER, 0.0).alias("coverage_percent")))
    return billing.billing_records(visits, procedures, insurance, payments)


BILLING = """
bill AS (SELECT l_orderkey AS visit_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_bill
         FROM lineitem GROUP BY 1),
paid AS (SELECT l_orderkey AS visit_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
         FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
cover AS (SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 90 WHEN 'BUILDING' THEN 80
                                 WHEN 'FURNITURE' THEN 60 WHEN 'HOUSEHOLD' THEN 50 ELSE 0 END AS DOUBLE) AS percent
          FROM customer),
records AS (
  SELECT *, CASE WHEN outstanding_balance = 0 THEN 'PAID' ELSE 'OUTSTANDING' END AS billing_status
  FROM (SELECT *, greatest(CAST(0 AS DOUBLE), total_bill - insurance_covered - amount_paid) AS outstanding_balance
        FROM (SELECT b.visit_id, o_custkey AS patient_id, o_orderpriority AS department, total_bill,
                     total_bill * coalesce(percent, 0) / 100 AS insurance_covered,
                     coalesce(amount, 0) AS amount_paid
              FROM bill b JOIN orders ON b.visit_id = o_orderkey LEFT JOIN paid USING (visit_id)
              LEFT JOIN cover ON o_custkey = c_custkey)))"""


@query("billing_chain", "WITH" + BILLING + """
SELECT visit_id, patient_id, department, total_bill, insurance_covered, amount_paid, outstanding_balance, billing_status FROM records""")
def billing_chain(spark, d):
    return _billing(spark, d)


@query("billing_high_value", "WITH" + BILLING + """
SELECT visit_id, patient_id, department, total_bill, insurance_covered, amount_paid, outstanding_balance, billing_status
FROM records WHERE total_bill > 200000""")
def billing_high_value(spark, d):
    """Typed records: the schema is checked before the filter."""
    contract = [(n, "bigint" if n in ("visit_id", "patient_id") else k) for n, k in BILLING_RECORD]
    return require_columns(_billing(spark, d), contract).where(F.col("total_bill") > 200000)


_REVENUE = "WITH" + BILLING + """
SELECT department, count(*) AS visit_count, CAST(sum(CAST(total_bill AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       CAST(sum(CAST(total_bill AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average_bill
FROM records GROUP BY department HAVING sum(total_bill) > 1000"""


@query("having_df", _REVENUE)
def having_df(spark, d):
    return billing.department_revenue(_billing(spark, d), 1000)


@query("having_sql", _REVENUE)
def having_sql(spark, d):
    return billing.department_revenue_sql(_billing(spark, d), 1000.0)


# ---- lookups and defaults --------------------------------------------------

@query("lookup_default", """
SELECT o_orderkey, coalesce(c_name, 'Unknown') AS customer_name,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Technology' WHEN '2-HIGH' THEN 'Finance'
            WHEN '3-MEDIUM' THEN 'Human Resources' ELSE 'Unknown' END AS department_name
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 > 0) ON o_custkey = c_custkey""")
def lookup_default(spark, d):
    names = read(spark, d, "customer").where(F.col("c_custkey") % 3 > 0).withColumnRenamed("c_custkey", "o_custkey")
    labels = {"1-URGENT": "Technology", "2-HIGH": "Finance", "3-MEDIUM": "Human Resources"}
    out = lookup_join(read(spark, d, "orders"), names, "o_custkey", "c_name", "Unknown")
    return out.select("o_orderkey", F.col("c_name").alias("customer_name"),
                      lookup(F.col("o_orderpriority"), labels).alias("department_name"))


@query("latest_reading_enrich", """
SELECT o_orderkey, r.value AS rain_mm_h, r.user_id AS temp_c
FROM orders, (SELECT value, user_id FROM events WHERE event_type = 'signup' ORDER BY ts DESC LIMIT 1) r""")
def latest_reading_enrich(spark, d):
    readings = (read(spark, d, "events").where(F.col("event_type") == "signup")
                .select("ts", F.col("value").alias("rain_mm_h"), F.col("user_id").alias("temp_c")))
    return with_newest(read(spark, d, "orders").select("o_orderkey"), readings, "ts", ["rain_mm_h", "temp_c"])


@query("zones_zero_filled", with_(REQUESTS, ZONES) + """
SELECT z.zone_id, zone_name, coalesce(demand, 0) AS demand, coalesce(multiplier, 1.0) AS multiplier
FROM zones z LEFT JOIN (SELECT zone_id, count(*) AS demand, CAST(1.5 AS DOUBLE) AS multiplier FROM requests
                        WHERE zone_id % 4 > 0 GROUP BY 1) USING (zone_id)""")
def zones_zero_filled(spark, d):
    demand = (mapping.raw_requests(spark, d).where(F.col("zone_id") % 4 > 0).groupBy("zone_id")
              .agg(F.count(F.lit(1)).alias("demand")).withColumn("multiplier", F.lit(1.5)))
    zones = zone_table(spark).select("zone_id", "zone_name")
    return zero_filled(zones, demand, "zone_id", {"demand": 0, "multiplier": 1.0}).withColumn("zone_id", big("zone_id"))

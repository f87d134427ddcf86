"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import chunked_lists, counted, mean, money, rank_by_count, salted_agg, subtotals, total
from millrace.plans import logs, mapping, transactions, visits
from millrace.queries.registry import day, query
from millrace.queries.views import TRANSACTIONS
from millrace.tables import read


def D(expr: str) -> str:
    """Exact sum in SQL."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


@query("group_count", "SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1")
def group_count(spark, d):
    return read(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("group_multi_agg", f"""
SELECT o_orderstatus, count(*) AS row_count, {D('o_totalprice')} AS total_price, {D('o_totalprice')} / count(*) AS mean_price,
       min(o_totalprice) AS min_price, max(o_totalprice) AS max_price FROM orders GROUP BY 1""")
def group_multi_agg(spark, d):
    return read(spark, d, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"), total("o_totalprice").alias("total_price"),
        mean("o_totalprice").alias("mean_price"), F.min("o_totalprice").alias("min_price"),
        F.max("o_totalprice").alias("max_price"))


@query("global_stats", f"""
SELECT count(*) AS row_count, {D('l_extendedprice')} AS total_price, {D('l_extendedprice')} / count(*) AS mean_price,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM lineitem""")
def global_stats(spark, d):
    return read(spark, d, "lineitem").agg(
        F.count(F.lit(1)).alias("row_count"), total("l_extendedprice").alias("total_price"),
        mean("l_extendedprice").alias("mean_price"), F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"))


@query("conditional_agg", f"""
SELECT l_shipmonth, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_quantity >= 25) AS large,
       CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS finished_value
FROM (SELECT *, strftime(l_shipdate, '%Y-%m') AS l_shipmonth FROM lineitem) GROUP BY 1""")
def conditional_agg(spark, d):
    return (read(spark, d, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth"))
            .agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"),
                 F.count_if(F.col("l_quantity") >= 25).alias("large"),
                 total(F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).otherwise(0.0))
                 .alias("finished_value")))


@query("group_two_keys", f"""
SELECT c_mktsegment, c_nationkey, count(*) AS row_count, {D('c_acctbal')} AS total_balance FROM customer GROUP BY 1, 2""")
def group_two_keys(spark, d):
    return read(spark, d, "customer").groupBy("c_mktsegment", "c_nationkey").agg(
        F.count(F.lit(1)).alias("row_count"), total("c_acctbal").alias("total_balance"))


@query("agg_rollup", f"""
SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS level, count(*) AS row_count,
       {D('l_extendedprice')} AS total_price FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def agg_rollup(spark, d):
    return subtotals(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice",
                     names=("level", "row_count", "total_price"))


@query("agg_cube", f"""
SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS level, count(*) AS row_count,
       {D('l_extendedprice')} AS total_price FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def agg_cube(spark, d):
    return subtotals(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", cube=True,
                     names=("level", "row_count", "total_price"))


@query("rounded_agg", """
SELECT o_orderpriority, count(*) AS row_count, CAST(sum(cents) AS DOUBLE) / 100 AS total_price,
       CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS mean_price
FROM (SELECT o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS cents FROM orders) GROUP BY 1""")
def rounded_agg(spark, d):
    """Totals and means to the cent; the mean is rounded half up from the exact sum."""
    exact = F.sum(money("o_totalprice"))
    return read(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(exact, 2).cast("double").alias("total_price"),
        F.round(exact / F.count(F.lit(1)), 2).cast("double").alias("mean_price"))


@query("distinct_counts", """
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_visitors, count(DISTINCT event_type) AS pages FROM events""")
def distinct_counts(spark, d):
    """Both distinct counts from one table of (visitor, page) pairs."""
    pairs = read(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(F.sum("n").alias("total_events"), F.count_distinct("user_id").alias("unique_visitors"),
                     F.count_distinct("event_type").alias("pages"))


@query("approx_distinct", """
SELECT event_type, count(DISTINCT user_id) AS users, true AS estimate_within_3_percent FROM events GROUP BY 1""")
def approx_distinct(spark, d):
    """Distinct users per event type, and whether the estimate (1% standard error) is near the exact count.

    Both are taken from the distinct pairs: beside a distinct count over the
    events, every (type, user) would carry a sketch of its own.
    """
    pairs = read(spark, d, "events").select("event_type", "user_id").distinct()
    exact, estimate = F.count("user_id"), F.approx_count_distinct("user_id", 0.01)
    return pairs.groupBy("event_type").agg(
        exact.alias("users"), (F.abs(estimate - exact) <= exact * 0.03).alias("estimate_within_3_percent"))


@query("keyed_sum", f"SELECT l_suppkey, {D('l_extendedprice')} AS total_price FROM lineitem GROUP BY 1")
def keyed_sum(spark, d):
    return read(spark, d, "lineitem").groupBy("l_suppkey").agg(total("l_extendedprice").alias("total_price"))


@query("keyed_list", """
SELECT o_custkey, (rn - 1) // 1000 AS part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY rn) AS orders
FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
GROUP BY 1, 2""")
def keyed_list(spark, d):
    """Each customer's orders as lists of at most 1000, so no key becomes one huge row."""
    lists = chunked_lists(read(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey",
                          [("o_orderkey", False)])
    return lists.select("o_custkey", "part", F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("orders"))


@query("max_row", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def max_row(spark, d):
    best = F.max_by(F.struct("o_orderkey", "o_custkey", "o_totalprice"),
                    F.struct("o_totalprice", -F.col("o_orderkey")))
    return read(spark, d, "orders").agg(best.alias("r")).select("r.*")


@query("counter_agg", f"""
SELECT count(*) FILTER (o_totalprice > 200000) AS large_orders, count(*) FILTER (o_orderstatus = 'P') AS pending,
       {D('o_totalprice')} AS total_price FROM orders""")
def counter_agg(spark, d):
    """Counters that fill beside a job, here the total of all orders."""
    watched, seen = counted(read(spark, d, "orders"), {"large_orders": F.count_if(F.col("o_totalprice") > 200000),
                                                       "pending": F.count_if(F.col("o_orderstatus") == "P")})
    price = watched.agg(total("o_totalprice").alias("total_price")).first()["total_price"]
    return spark.createDataFrame([(seen.get["large_orders"], seen.get["pending"], price)],
                                 "large_orders bigint, pending bigint, total_price double")


@query("salted_agg", f"""
SELECT l_returnflag, count(*) AS row_count, {D('l_extendedprice')} AS total, {D('l_extendedprice')} / count(*) AS mean
FROM lineitem GROUP BY 1""")
def salted_agg_query(spark, d):
    """Two-phase totals with the hot flag N spread over eight salts."""
    return salted_agg(read(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", F.col("l_orderkey"), 8,
                      hot=F.col("l_returnflag") == "N")


# ---- transactions ----------------------------------------------------------

@query("validate_transactions", "WITH" + TRANSACTIONS + """
SELECT transaction_id, customer_id, transaction_time, strftime(transaction_time, '%Y-%m-%d') AS transaction_date,
       good_amount AS amount, category, status FROM clean""")
def validate_transactions(spark, d):
    return (transactions.clean(mapping.transactions(spark, d))
            .withColumn("transaction_date", day("transaction_date")))


@query("daily_totals", "WITH" + TRANSACTIONS + f"""
SELECT strftime(transaction_time, '%Y-%m-%d') AS transaction_date, count(*) AS transaction_count, {D('good_amount')} AS total_amount
FROM clean GROUP BY 1""")
def daily_totals(spark, d):
    return (transactions.daily_totals(transactions.clean(mapping.transactions(spark, d)))
            .withColumn("transaction_date", day("transaction_date")))


@query("category_totals", "WITH" + TRANSACTIONS + f"""
SELECT category, count(*) AS transaction_count, {D('good_amount')} AS total_amount FROM clean GROUP BY 1""")
def category_totals(spark, d):
    return transactions.category_totals(transactions.clean(mapping.transactions(spark, d)))


# ---- logs and visits -------------------------------------------------------

@query("error_percentage", """
SELECT count(*) AS total_requests, count(*) FILTER (event_type = 'error') AS total_errors,
       count(*) FILTER (event_type = 'error') * CAST(100 AS DOUBLE) / count(*) AS error_percentage FROM events""")
def error_percentage(spark, d):
    return logs.error_share(read(spark, d, "events"), level="event_type")


@query("rank_by_key", "SELECT user_id, count(*) AS count FROM events WHERE event_type = 'error' GROUP BY 1")
def rank_by_key(spark, d):
    return rank_by_count(read(spark, d, "events"), "user_id", where=F.col("event_type") == "error")


@query("url_performance", "SELECT user_id AS url, round(avg(value), 6) AS avg_response_time FROM events GROUP BY 1")
def url_performance(spark, d):
    rows = read(spark, d, "events").select(F.col("user_id").alias("url"), F.col("value").alias("response_time"))
    return logs.performance(rows).withColumn("avg_response_time", F.round("avg_response_time", 6))


@query("visit_stats", """
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_visitors, count(DISTINCT event_type) AS total_pages,
       (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1) AS top_page,
       (SELECT count(*) FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1) AS top_page_visits
FROM events""")
def visit_stats(spark, d):
    return visits.visit_stats(read(spark, d, "events"), "user_id", "event_type")


@query("recent_visits", "SELECT event_id, user_id, event_type, ts FROM events ORDER BY event_id DESC LIMIT 10")
def recent_visits(spark, d):
    return visits.recent_visits(read(spark, d, "events"), "event_id", ["user_id", "event_type", "ts"])


@query("slow_requests", "SELECT event_id, value FROM events WHERE value > 40")
def slow_requests(spark, d):
    return logs.slow_requests(read(spark, d, "events"), 40, "value").select("event_id", "value")


@query("department_totals", f"""
SELECT o_orderpriority, CASE WHEN o_totalprice / 20 >= 7000 THEN 'High' WHEN o_totalprice / 20 >= 4000 THEN 'Medium' ELSE 'Low' END AS type,
       count(*) AS transaction_count, {D('o_totalprice')} AS total_amount,
       round({D('o_totalprice')} * share, 4) AS percent_of_all
FROM (SELECT *, CAST(100 AS DOUBLE) / (SELECT {D('o_totalprice')} FROM orders) AS share FROM orders) GROUP BY 1, 2, share""")
def department_totals(spark, d):
    """Totals per priority and amount class, with each total's share of all orders."""
    from millrace.functions.bands import transaction_band

    orders = read(spark, d, "orders")
    share = orders.agg((F.lit(100.0) / total("o_totalprice")).alias("s")).scalar()
    per_class = orders.groupBy("o_orderpriority", transaction_band(F.col("o_totalprice") / 20).alias("type")).agg(
        F.count(F.lit(1)).alias("transaction_count"), total("o_totalprice").alias("total_amount"))
    return per_class.withColumn("percent_of_all", F.round(F.col("total_amount") * share, 4))


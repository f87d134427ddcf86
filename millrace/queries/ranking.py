"""Window, sort and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import mean, newest_per_key, top_by
from millrace.operators.ordered import numbered, ranked_by_value, running_sum, shifted
from millrace.plans import demand
from millrace.queries.demand import priced, priced_once
from millrace.queries.registry import big, query
from millrace.queries.views import PRICED, with_
from millrace.tables import read

BY_BALANCE = [("c_acctbal", True), ("c_custkey", False)]
W = "OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)"


def staff(spark, d):
    return read(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")


@query("win_row_number", f"SELECT c_custkey, c_mktsegment, row_number() {W} AS row_number FROM customer")
def win_row_number(spark, d):
    return numbered(staff(spark, d), ["c_mktsegment"], BY_BALANCE).select("c_custkey", "c_mktsegment", "row_number")


@query("win_rank", "SELECT c_custkey, c_mktsegment, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey DESC) AS rank FROM customer")
def win_rank(spark, d):
    return (ranked_by_value(staff(spark, d), ["c_mktsegment"], "c_nationkey")
            .select("c_custkey", "c_mktsegment", "rank"))


@query("win_dense_rank", """
SELECT c_custkey, c_mktsegment, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey DESC) AS dense_rank FROM customer""")
def win_dense_rank(spark, d):
    return (ranked_by_value(staff(spark, d), ["c_mktsegment"], "c_nationkey", rank=None, dense_rank="dense_rank")
            .select("c_custkey", "c_mktsegment", "dense_rank"))


@query("win_top1", f"""
SELECT c_custkey, c_mktsegment, c_acctbal FROM (SELECT *, row_number() {W} AS rn FROM customer) WHERE rn = 1""")
def win_top1(spark, d):
    top = newest_per_key(staff(spark, d), ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")])
    return top.select("c_custkey", "c_mktsegment", "c_acctbal")


@query("win_partition_avg", """
SELECT c_custkey, c_acctbal, avg_balance, c_acctbal - avg_balance AS difference FROM customer JOIN (
  SELECT c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_balance
  FROM customer GROUP BY 1) USING (c_mktsegment)""")
def win_partition_avg(spark, d):
    """Group means joined back: a window would pull each group into one task."""
    rows = staff(spark, d)
    means = rows.groupBy("c_mktsegment").agg(mean("c_acctbal").alias("avg_balance"))
    return (rows.join(means, "c_mktsegment")
            .select("c_custkey", "c_acctbal", "avg_balance", (F.col("c_acctbal") - F.col("avg_balance")).alias("difference")))


@query("win_lag", f"SELECT c_custkey, c_acctbal, lag(c_acctbal) {W} AS previous_balance FROM customer")
def win_lag(spark, d):
    return (shifted(staff(spark, d), ["c_mktsegment"], BY_BALANCE, "c_acctbal", "previous_balance")
            .select("c_custkey", "c_acctbal", "previous_balance"))


@query("win_lead", f"SELECT c_custkey, c_acctbal, lead(c_acctbal) {W} AS next_balance FROM customer")
def win_lead(spark, d):
    return (shifted(staff(spark, d), ["c_mktsegment"], BY_BALANCE, "c_acctbal", "next_balance", ahead=True)
            .select("c_custkey", "c_acctbal", "next_balance"))


@query("win_running_sum", """
SELECT o_orderkey, o_orderstatus,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM orders""")
def win_running_sum(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate",
                                           F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = running_sum(rows, ["o_orderstatus"], [("o_orderdate", False), ("o_orderkey", False)], "price", "running_total")
    return out.select("o_orderkey", "o_orderstatus", F.col("running_total").cast("double").alias("running_total"))


@query("surrogate_key", "SELECT c_custkey, row_number() OVER (ORDER BY c_name) AS customer_key FROM customer")
def surrogate_key(spark, d):
    rows = read(spark, d, "customer").select("c_custkey", "c_name")
    return numbered(rows, [], [("c_name", False)], "customer_key").select("c_custkey", "customer_key")


@query("sort_desc", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort_desc(spark, d):
    return (read(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
            .orderBy("c_mktsegment", F.desc("c_acctbal"), "c_custkey"))


@query("top_one", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1")
def top_one(spark, d):
    return read(spark, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(1)


_LATEST = """,
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY window_end DESC) AS rn FROM priced) WHERE rn = 1)
"""


@query("latest_per_key", with_(PRICED + _LATEST) + "SELECT zone_id, window_end, demand, surge_multiplier FROM latest")
def latest_per_key(spark, d):
    return (demand.latest_rows(priced(spark, d))
            .select(big("zone_id").alias("zone_id"), "window_end", "demand", "surge_multiplier"))


@query("top_zones", with_(PRICED + _LATEST) + """
SELECT zone_id, window_end, ratio FROM latest ORDER BY ratio DESC, zone_id LIMIT 5""")
def top_zones(spark, d):
    metrics = {"surge_multiplier": "surge_multiplier", "surge": "surge_multiplier", "demand": "demand", "ratio": "ratio"}
    return (top_by(demand.latest_rows(priced(spark, d)), "ratio", metrics, "zone_id", 5)
            .select(big("zone_id").alias("zone_id"), "window_end", "ratio"))


@query("current_surge", with_(PRICED + _LATEST) + """
SELECT zone_id, window_end, surge_multiplier, demand, drivers_available AS supply, ratio FROM latest WHERE zone_id = 7""")
def current_surge(spark, d):
    """Latest figures of the zone found by the name ' zone 07'."""
    from millrace.functions.geo import zone_table
    from millrace.functions.scalars import matches_text

    wanted = (zone_table(spark).where(matches_text(F.col("zone_name"), " zone 07"))
              .agg(F.min("zone_id").alias("z")).scalar())
    rows = priced(spark, d).where(F.col("zone_id") == wanted)
    return demand.latest_rows(rows).select(big("zone_id").alias("zone_id"), "window_end", "surge_multiplier", "demand",
                                           F.col("drivers_available").alias("supply"), "ratio")


@query("key_history", with_(PRICED) + """
SELECT zone_id, window_end, surge_multiplier FROM priced
WHERE zone_id = 7 AND window_end >= (SELECT max(window_end) FROM priced) - INTERVAL 2880 MINUTE""")
def key_history(spark, d):
    return (demand.history(priced_once(spark, d), 7, 2880)
            .select(big("zone_id").alias("zone_id"), "window_end", "surge_multiplier"))

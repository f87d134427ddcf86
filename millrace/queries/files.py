"""Sources and sinks: the given tables written and read back, against SQL over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.layout import (partition_count, plan_text, planned_repartition, salt_plan, salted_repartition, shrink,
                                       spread)
from millrace.plans import mapping
from millrace.queries.registry import big, query
from millrace.queries.streams import landed
from millrace.session import cached, checkpointed, shared_folder
from millrace.sinks import files as sinks
from millrace.sources import batch, catalog
from millrace.sources.incremental import full_refresh, import_changes, read_version
from millrace.tables import TRANSACTIONS_TEXT, read


@query("csv_report", """SELECT c_mktsegment, count(*) AS customers, count(DISTINCT c_nationkey) AS nations,
CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, 1 AS files FROM customer GROUP BY 1""")
def csv_report(spark, d):
    """A report of a row per segment: one file with a header, read back with inferred types."""
    path = shared_folder(spark, "report")
    sinks.report_csv(read(spark, d, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.count_distinct("c_nationkey").alias("nations"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance")), path)
    back = batch.csv_table(spark, path, None)
    files = back.select(F.input_file_name().alias("f")).agg(F.count_distinct("f").alias("n")).scalar()
    return back.select("c_mktsegment", big("customers").alias("customers"), big("nations").alias("nations"), "balance",
                       files.alias("files"))


@query("csv_export", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def csv_export(spark, d):
    """A whole table as CSV: as many files as its partitions, none of them through one task."""
    path = shared_folder(spark, "export")
    sinks.report_csv(read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, files=None)
    return batch.csv_table(spark, path, None).withColumn("c_custkey", big("c_custkey"))


@query("csv_partitioned", "SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1")
def csv_partitioned(spark, d):
    path = shared_folder(spark, "csv")
    sinks.partitioned_csv(read(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, "o_orderstatus")
    return spark.read.option("header", True).csv(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("csv_clustered", "SELECT o_orderpriority, count(*) AS row_count, true AS one_file FROM orders GROUP BY 1")
def csv_clustered(spark, d):
    """Rows are brought together by the partition column first, so small values have one file each."""
    path = shared_folder(spark, "csv")
    sinks.clustered_csv(read(spark, d, "orders").select("o_orderkey", "o_orderpriority"), path, "o_orderpriority")
    rows = spark.read.option("header", True).csv(path).select("o_orderpriority", F.input_file_name().alias("f"))
    return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("row_count"), (F.count_distinct("f") == 1).alias("one_file"))


@query("text_lines", "SELECT 'order ' || o_orderkey AS value FROM orders")
def text_lines(spark, d):
    lines = read(spark, d, "orders").select(F.concat(F.lit("order "), "o_orderkey").alias("value"))
    return batch.text_lines(spark, landed(lines, "text"))


@query("headerless_log", "SELECT event_id, event_type, user_id FROM events")
def headerless_log(spark, d):
    """A log without a header; the schema names its columns."""
    rows = read(spark, d, "events").select("event_id", "event_type", "user_id")
    return batch.delimited_log(spark, landed(rows, "csv", sep="|"), "event_id bigint, event_type string, user_id bigint", "|")


@query("csv_as_text", """
SELECT count(*) AS row_count, count(*) FILTER (o_orderkey % 83 = 0) AS bad_times, count(*) FILTER (o_orderkey % 79 = 0) AS bad_amounts FROM orders""")
def csv_as_text(spark, d):
    """Dirty text columns come through as they are."""
    columns = [c.split()[0] for c in TRANSACTIONS_TEXT.split(", ")]
    rows = batch.csv_as_text(spark, landed(mapping.transactions(spark, d), "csv", header="true"), columns)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("transaction_timestamp") == "not-a-timestamp").alias("bad_times"),
                    F.count_if(F.col("amount") == "not-a-number").alias("bad_amounts"))


@query("json_table", "SELECT event_id, user_id, event_type FROM events")
def json_table(spark, d):
    rows = read(spark, d, "events").select("event_id", "user_id", "event_type")
    return batch.json_table(spark, landed(rows, "json"), "event_id bigint, user_id bigint, event_type string")


@query("literal_rows", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partly' END AS label FROM orders""")
def literal_rows(spark, d):
    """Literal rows in three slices, joined to a table."""
    labels = batch.rows_table(spark, [("F", "finished"), ("O", "open"), ("P", "partly")], "o_orderstatus string, label string", slices=3)
    return read(spark, d, "orders").join(labels, "o_orderstatus", "left").select("o_orderkey", "label")


@query("parquet_results", """
SELECT 'by_status' AS name, count(DISTINCT o_orderstatus) AS row_count FROM orders
UNION ALL SELECT 'by_priority', count(DISTINCT o_orderpriority) FROM orders""")
def parquet_results(spark, d):
    """Several results written together."""
    orders, base = read(spark, d, "orders"), shared_folder(spark, "results")
    tables = {name: orders.groupBy(c).count() for name, c in (("by_status", "o_orderstatus"), ("by_priority", "o_orderpriority"))}
    sinks.parquet_tables(tables, base)
    parts = [spark.read.parquet(f"{base}/{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("row_count")) for n in tables]
    return parts[0].unionAll(parts[1])


@query("full_refresh", "SELECT s_suppkey, s_name FROM supplier")
def full_refresh_query(spark, d):
    """A dimension replaced by its source, twice."""
    base = shared_folder(spark, "dimensions")
    for _ in range(2):
        full_refresh({"supplier": read(spark, d, "supplier").select("s_suppkey", "s_name")}, base)
    return spark.read.parquet(f"{base}/supplier")


@query("external_table", "SELECT o_orderstatus, count(*) AS row_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def external_table(spark, d):
    """A partitioned folder registered in the catalog, its partitions found by a repair."""
    path = shared_folder(spark, "external")
    sinks.partitioned_parquet(read(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, ["o_orderstatus"])
    name = "orders_" + path.rpartition("-")[2]
    catalog.register_external(spark, name, path, ["o_orderstatus"])
    found = spark.table(name).where("o_orderstatus <> 'P'")
    return found.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("import_twice", """
SELECT o_orderkey, CASE WHEN o_orderdate > (SELECT quantile_disc(o_orderdate, 0.5) FROM orders) THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def import_twice(spark, d):
    """A first import of everything, then one of the rows modified since."""
    orders = read(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("modified"))
    middle = orders.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_timestamp(modified))")).first()[0]
    table, late = shared_folder(spark, "imported"), F.unix_timestamp("modified") > int(middle)
    at_middle = F.timestamp_seconds(F.lit(int(middle)))
    import_changes(spark, orders.withColumn("modified", F.when(late, at_middle).otherwise(F.col("modified"))), table, "o_orderkey", "modified")
    changed = orders.withColumn("o_totalprice", F.when(late, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    import_changes(spark, changed, table, "o_orderkey", "modified")
    return read_version(spark, table).select("o_orderkey", "o_totalprice")


@query("import_growing", """
SELECT o_orderkey, CASE WHEN o_orderdate <= (SELECT quantile_disc(o_orderdate, 0.02) FROM orders) THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def import_growing(spark, d):
    """A table that grows fifty times over four imports, its buckets with it; then its oldest rows change."""
    orders = read(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("modified"))
    seconds, table = F.unix_timestamp("modified"), shared_folder(spark, "growing")
    *cuts, rows, newest = orders.agg(
        *[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY unix_timestamp(modified))") for q in (0.02, 0.1, 0.4, 1.0)],
        F.count(F.lit(1)), F.max("modified")).first()
    for cut in cuts:
        import_changes(spark, orders.where(seconds <= int(cut)), table, "o_orderkey", "modified", bucket_rows=max(1, rows // 60))
    oldest = orders.where(seconds <= int(cuts[0])).withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "modified": F.lit(newest) + F.expr("INTERVAL 1 DAY")})
    import_changes(spark, oldest, table, "o_orderkey", "modified", bucket_rows=max(1, rows // 60))
    return read_version(spark, table).select("o_orderkey", "o_totalprice")


@query("zone_map", "SELECT count(*) AS zones, min(zone_id) AS first_zone, max(zone_id) AS last_zone FROM (SELECT DISTINCT user_id % 40 + 1 AS zone_id FROM events)")
def zone_map(spark, d):
    """The zones that events fall into, written as a CSV map and read back."""
    path = shared_folder(spark, "zones")
    sinks.report_csv(read(spark, d, "events").select((F.col("user_id") % 40 + 1).alias("zone_id")).distinct(), path)
    return batch.csv_table(spark, path, "zone_id bigint").agg(
        F.count(F.lit(1)).alias("zones"), F.min("zone_id").alias("first_zone"), F.max("zone_id").alias("last_zone"))


@query("planned_layout", "SELECT l_returnflag, count(*) AS row_count, true AS salted, true AS even FROM lineitem GROUP BY 1")
def planned_layout(spark, d):
    """Hot flags are found and salted by their counts; no task gets more than three times its share."""
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    plan = salt_plan(lines, "l_returnflag", 16)
    dealt = planned_repartition(lines, "l_returnflag", ["l_orderkey", "l_linenumber"], plan, 16).withColumn("p", F.spark_partition_id())
    most = dealt.groupBy("p").count().agg((F.max("count") <= 3 * F.sum("count") / 16).alias("even")).scalar()
    return (dealt.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count"), (F.count_distinct("p") > 2).alias("salted"))
            .withColumn("even", most))


@query("layouts", "SELECT count(*) AS row_count, 8 AS spread_to, 2 AS shrunk_to, true AS hot_key_in_many FROM lineitem")
def layouts(spark, d):
    """Repartition, coalesce and a salted repartition of a hot flag: how many partitions each gives."""
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    wide = spread(lines, 8)
    salted = salted_repartition(lines, 16, "l_returnflag", F.col("l_orderkey"), 8, F.col("l_returnflag") == "N")
    parts = salted.where("l_returnflag = 'N'").select(F.spark_partition_id().alias("p")).agg(F.count_distinct("p").alias("n"))
    return wide.agg(F.count(F.lit(1)).alias("row_count"), F.lit(partition_count(wide)).cast("bigint").alias("spread_to"),
                    F.lit(partition_count(shrink(wide, 2))).cast("bigint").alias("shrunk_to")).withColumn(
                        "hot_key_in_many", parts.select(F.col("n") > 3).scalar())


@query("cached_reuse", """
SELECT c_mktsegment, count(*) AS customers, CAST(max(c_acctbal) AS DOUBLE) AS highest,
       (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS in_credit, true AS was_kept, true AS was_released
FROM customer WHERE c_acctbal > 0 GROUP BY 1""")
def cached_reuse(spark, d):
    """One filtered table kept in memory and on disk for two results, and let go after them."""
    rows = read(spark, d, "customer").select("c_mktsegment", "c_acctbal").where("c_acctbal > 0")
    with cached(rows):
        kept = rows.storageLevel.useMemory and rows.storageLevel.useDisk
        in_credit = rows.count()
        result = checkpointed(rows.groupBy("c_mktsegment").agg(
            F.count(F.lit(1)).alias("customers"), F.max("c_acctbal").cast("double").alias("highest")))
    released = not (rows.storageLevel.useMemory or rows.storageLevel.useDisk)
    return result.withColumns({"in_credit": F.lit(in_credit).cast("bigint"), "was_kept": F.lit(kept), "was_released": F.lit(released)})


@query("plan_inspected", """
SELECT l_returnflag, count(*) AS lines, true AS filter_pushed, true AS two_columns_read, 1 AS exchanges
FROM lineitem WHERE l_quantity > 45 GROUP BY 1""")
def plan_inspected(spark, d):
    """A grouped scan beside what its plan says: the filter and the columns reach the scan, one shuffle."""
    rows = (read(spark, d, "lineitem").where("l_quantity > 45").groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("lines")))
    plan = plan_text(rows)
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    return rows.withColumns({
        "filter_pushed": F.lit("GreaterThan(l_quantity" in plan), "two_columns_read": F.lit(schema.count(":") == 3),
        "exchanges": F.lit(sum(line.startswith("(") and ") Exchange" in line for line in plan.splitlines())).cast("bigint")})

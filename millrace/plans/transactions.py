"""Text transactions: typed, validated, summed by day and category."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.aggregates import counted, total
from millrace.operators.quality import all_hold, transaction_rules


def typed(raw: DataFrame) -> DataFrame:
    """Readable fields typed, unreadable ones null."""
    return (raw.withColumn("transaction_time", F.try_to_timestamp("transaction_timestamp"))
            .withColumn("amount_value", F.col("amount").try_cast("double"))
            .withColumn("transaction_date", F.to_date("transaction_time")))


def clean(raw: DataFrame) -> DataFrame:
    return (typed(raw).where(all_hold(transaction_rules()))
            .select("transaction_id", "customer_id", "transaction_time", "transaction_date",
                    F.col("amount_value").alias("amount"), "category", "status"))


def totals(transactions: DataFrame, key: str) -> DataFrame:
    return transactions.groupBy(key).agg(
        F.count(F.lit(1)).alias("transaction_count"), total("amount").alias("total_amount"))


def daily_totals(transactions: DataFrame) -> DataFrame:
    return totals(transactions, "transaction_date").orderBy("transaction_date")


def category_totals(transactions: DataFrame) -> DataFrame:
    return totals(transactions, "category").orderBy(F.desc("total_amount"), "category")


def run(raw: DataFrame, base: str) -> dict[str, int]:
    """The whole pipeline: three Parquet results and the reject counts.

    The input is parsed once: rejects are counted beside the write of the clean
    rows, and the summaries read the written columns they need.
    """
    valid = F.coalesce(all_hold(transaction_rules()), F.lit(False))
    rows, seen = counted(typed(raw), {"raw_rows": F.count(F.lit(1)), "valid_rows": F.count_if(valid),
                                      "rejected_rows": F.count_if(~valid)})
    rows.where(valid).select(
        "transaction_id", "customer_id", "transaction_time", "transaction_date",
        F.col("amount_value").alias("amount"), "category", "status",
    ).write.mode("overwrite").parquet(f"{base}/clean_transactions")
    good = raw.sparkSession.read.parquet(f"{base}/clean_transactions")
    daily_totals(good).write.mode("overwrite").parquet(f"{base}/daily_summary")
    category_totals(good).write.mode("overwrite").parquet(f"{base}/category_summary")
    return dict(seen.get)

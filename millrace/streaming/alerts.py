"""Stateless classification and alerts; the same functions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.bands import first_match, payment_band, risk_band, transaction_band

# Limits and message texts.
ALERT_LIMIT = 10000
HIGH_VALUE_LIMIT = 100000.0
ALERT_PARTS = ("🚨 HIGH-RISK ALERT | Transaction: ", " | Employee: ", " | Department: ", " | Amount: ₹")


def classified(rows: DataFrame, amount: str = "amount", name: str = "transactionType") -> DataFrame:
    return rows.withColumn(name, transaction_band(F.col(amount)))


def with_risk(rows: DataFrame, amount: str = "amount", name: str = "riskLevel") -> DataFrame:
    return rows.withColumn(name, risk_band(F.col(amount)))


def with_payment_category(payments: DataFrame) -> DataFrame:
    return payments.withColumn("payment_category", payment_band(F.col("payment_amount")))


def threshold_alerts(rows: DataFrame, limit: float = ALERT_LIMIT) -> DataFrame:
    """Level and message of every transaction at or above the limit.

    A message with an unknown part is null, as string concatenation has it.
    """
    head, employee, department, amount = (F.lit(p) for p in ALERT_PARTS)
    message = F.concat(head, F.col("transactionId").cast("string"), employee, F.col("employeeId").cast("string"),
                       department, "department", amount, F.col("amount").cast("string"))
    return rows.where(F.col("amount") >= limit).select(
        F.lit("HIGH_RISK").alias("alertLevel"), message.alias("alertMessage"))


def card_alerts(rows: DataFrame, limit: float = HIGH_VALUE_LIMIT) -> DataFrame:
    """High-value or international card transactions with the reason."""
    high = F.col("amount") >= limit
    abroad = F.coalesce("is_international", F.lit(False))
    reason = first_match([(high, F.lit("HIGH_VALUE")), (abroad, F.lit("INTERNATIONAL"))], F.lit("REVIEW"))
    return (rows.where(F.col("amount").isNotNull() & (high | abroad))
            .select("transaction_id", "account_id", "amount", "merchant", "country", "event_timestamp",
                    "is_international", reason.alias("alert_reason")))

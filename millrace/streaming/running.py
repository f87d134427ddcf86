"""Running totals per key over a whole stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.aggregates import money
from millrace.streaming.alerts import classified, with_risk


def running_totals(rows: DataFrame, keys: Sequence[str], amount: str = "amount",
                   names: tuple[str, str, str] = ("transactionCount", "totalAmount", "averageAmount")) -> DataFrame:
    """Count, total and mean per key.  State grows with the keys only."""
    value = money(amount)
    count, total, average = names
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), F.sum(value).cast("double").alias(total),
                                   F.round(F.avg(value), 2).cast("double").alias(average))


def department_totals(rows: DataFrame, key: str = "department", amount: str = "amount") -> DataFrame:
    return running_totals(classified(rows, amount), [key], amount)


def risk_totals(rows: DataFrame) -> DataFrame:
    return running_totals(with_risk(rows), ["riskLevel"])


def department_risk_totals(rows: DataFrame) -> DataFrame:
    """Per department and risk level, sorted: needs complete output mode on a stream."""
    return running_totals(with_risk(rows), ["department", "riskLevel"]).orderBy("department", "riskLevel")

"""Visit billing: bill, insurance cover, payments, balance, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.aggregates import mean, total


def status(balance: Column, due_label: str = "OUTSTANDING") -> Column:
    return F.when(balance == 0.0, "PAID").otherwise(due_label)


def billing_records(visits: DataFrame, procedures: DataFrame, insurance: DataFrame,
                    payments: DataFrame, due_label: str = "OUTSTANDING") -> DataFrame:
    """One row per visit with at least one procedure.

    Procedures and payments are summed per visit before the joins, so a visit
    never fans out and a visit with very many lines is combined on the map side.
    """
    bills = procedures.groupBy("visit_id").agg(total("procedure_cost").alias("total_bill"))
    paid = payments.groupBy("visit_id").agg(total("payment_amount").alias("amount_paid"))
    rows = (visits.select("visit_id", "patient_id", "department")
            .join(bills, "visit_id")
            .join(paid, "visit_id", "left")
            .join(insurance.select("patient_id", "coverage_percent"), "patient_id", "left"))
    covered = F.col("total_bill") * F.coalesce("coverage_percent", F.lit(0.0)) / 100
    paid_sum = F.coalesce("amount_paid", F.lit(0.0))
    return (rows.withColumn("insurance_covered", covered)
            .withColumn("amount_paid", paid_sum)
            .withColumn("outstanding_balance",
                        F.greatest(F.lit(0.0), F.col("total_bill") - F.col("insurance_covered") - F.col("amount_paid")))
            .withColumn("billing_status", status(F.col("outstanding_balance"), due_label))
            .select("visit_id", "patient_id", "department", "total_bill", "insurance_covered",
                    "amount_paid", "outstanding_balance", "billing_status"))


def department_revenue(records: DataFrame, more_than: float) -> DataFrame:
    return (records.groupBy("department")
            .agg(F.count(F.lit(1)).alias("visit_count"), total("total_bill").alias("total_revenue"),
                 mean("total_bill").alias("average_bill"))
            .where(F.col("total_revenue") > more_than)
            .orderBy(F.desc("total_revenue"), "department"))


def department_revenue_sql(records: DataFrame, more_than: float, view: str = "billing_records") -> DataFrame:
    """The same answer from SQL text over a temporary view."""
    records.createOrReplaceTempView(view)
    return records.sparkSession.sql(
        f"""SELECT department, count(*) AS visit_count,
                   CAST(sum(CAST(total_bill AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
                   CAST(sum(CAST(total_bill AS DECIMAL(18,2))) AS DOUBLE) / count(total_bill) AS average_bill
            FROM {view} GROUP BY department
            HAVING CAST(sum(CAST(total_bill AS DECIMAL(18,2))) AS DOUBLE) > :more_than
            ORDER BY total_revenue DESC, department""", args={"more_than": more_than})

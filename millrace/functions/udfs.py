"""User-defined functions: the hook for rules that built-ins cannot express.

They run on Arrow batches.  Each one here has a built-in twin in
``functions.bands`` that Catalyst can see through; prefer the twin.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession, functions as F, types as T


def _bands(values: pd.Series, high: float, medium: float, names: tuple[str, str, str]) -> pd.Series:
    out = pd.Series(names[2], index=values.index, dtype="object")
    out[values >= medium] = names[1]
    out[values >= high] = names[0]
    return out


@F.pandas_udf(T.StringType())
def salary_category(salary: pd.Series) -> pd.Series:
    return _bands(salary, 65000, 55000, ("High", "Medium", "Low"))


@F.pandas_udf(T.StringType())
def experience_level(years: pd.Series) -> pd.Series:
    return _bands(years, 7, 4, ("Senior", "Mid-Level", "Junior"))


@F.pandas_udf(T.DoubleType())
def bonus(salary: pd.Series) -> pd.Series:
    return salary * 0.10


@F.pandas_udf(T.StringType())
def employee_grade(salary: pd.Series, years: pd.Series) -> pd.Series:
    out = pd.Series("C", index=salary.index, dtype="object")
    out[(salary >= 55000) & (years >= 4)] = "B"
    out[(salary >= 65000) & (years >= 7)] = "A"
    return out


@F.pandas_udf(T.StringType())
def describe(name: pd.Series, department: pd.Series, years: pd.Series) -> pd.Series:
    return name + " works in " + department + " with " + years.astype("Int64").astype("string") + " years experience"


@F.pandas_udf(T.StringType())
def billing_status(balance: pd.Series) -> pd.Series:
    out = pd.Series("DUE", index=balance.index, dtype="object")
    out[balance == 0.0] = "PAID"
    return out


SQL_NAMES = {"salary_category_sql": salary_category, "experience_level_sql": experience_level,
             "employee_grade_sql": employee_grade, "billing_status_sql": billing_status}


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL text."""
    for name, function in SQL_NAMES.items():
        spark.udf.register(name, function)

"""Ordered bands: the first matching rule names the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Band tables as (inclusive lower bound, label), highest first.
SALARY_BANDS = ((65000, "High"), (55000, "Medium"))
SALARY_BANDS_LOW_MEDIUM = ((65000, "High"), (50000, "Medium"))
EXPERIENCE_BANDS = ((7, "Senior"), (4, "Mid-Level"))
GRADE_BANDS = ((90, "A"), (80, "B"), (70, "C"), (50, "D"))
TRANSACTION_BANDS = ((7000, "High"), (4000, "Medium"))
RISK_BANDS = ((10000, "HIGH_RISK"), (5000, "SUSPICIOUS"))
AMOUNT_BANDS = ((500, "HIGH"), (200, "MEDIUM"))
PAYMENT_BANDS = ((2000, "HIGH"),)


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """``CASE WHEN`` over (condition, value) rules; ``default`` when none holds."""
    (condition, value), *rest = rules
    case = F.when(condition, value)
    for condition, value in rest:
        case = case.when(condition, value)
    return case.otherwise(default)


def band(value: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label ``value`` by the first lower bound it reaches (null -> ``otherwise``)."""
    return first_match([(value >= F.lit(low), F.lit(label)) for low, label in bands],
                       F.lit(otherwise))


def salary_band(value: Column, bands=SALARY_BANDS) -> Column:
    return band(value, bands, "Low")


def experience_band(value: Column) -> Column:
    return band(value, EXPERIENCE_BANDS, "Junior")


def grade_band(value: Column) -> Column:
    return band(value, GRADE_BANDS, "F")


def transaction_band(value: Column) -> Column:
    return band(value, TRANSACTION_BANDS, "Low")


def risk_band(value: Column) -> Column:
    return band(value, RISK_BANDS, "NORMAL")


def amount_band(value: Column) -> Column:
    return band(value, AMOUNT_BANDS, "LOW")


def payment_band(value: Column) -> Column:
    return band(value, PAYMENT_BANDS, "NORMAL")


def joint_grade(salary: Column, experience: Column) -> Column:
    """A / B need both the salary and the experience bound; C otherwise."""
    pairs: list[tuple[float, float, str]] = [(65000, 7, "A"), (55000, 4, "B")]
    return first_match([((salary >= s) & (experience >= e), F.lit(g)) for s, e, g in pairs],
                       F.lit("C"))


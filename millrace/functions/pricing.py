"""Demand/supply pricing rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.bands import first_match

# Upper bounds of the ratio and the multiplier below each, the
# bound at 3.0 being inclusive; weather limits and surcharges; cap and step.
RATIO_RULES = ((1.0, 1.0), (1.5, 1.2), (2.0, 1.5))
RATIO_INCLUSIVE = (3.0, 2.0)
RATIO_TOP = 2.5
RAIN_LIMIT_MM_H, RAIN_SURCHARGE = 2.5, 0.2
TEMP_LOW_C, TEMP_HIGH_C, TEMP_SURCHARGE = 5.0, 35.0, 0.1
MULTIPLIER_CAP = 3.0
MAX_STEP = 0.3
LOOKBACK_STEPS = 10


def demand_ratio(demand: Column, supply: Column) -> Column:
    return demand.cast("double") / F.greatest(supply, F.lit(1)).cast("double")


def base_multiplier(ratio: Column) -> Column:
    rules = [(ratio < bound, F.lit(value)) for bound, value in RATIO_RULES]
    bound, value = RATIO_INCLUSIVE
    return first_match([*rules, (ratio <= bound, F.lit(value))], F.lit(RATIO_TOP))


def weather_surcharge(rain: Column, temp: Column) -> Column:
    """Missing readings add nothing."""
    wet = F.coalesce(rain >= RAIN_LIMIT_MM_H, F.lit(False))
    harsh = F.coalesce((temp < TEMP_LOW_C) | (temp > TEMP_HIGH_C), F.lit(False))
    return F.bround(F.when(wet, RAIN_SURCHARGE).otherwise(0.0)
                    + F.when(harsh, TEMP_SURCHARGE).otherwise(0.0), 2)


def smooth_step(target: Column, previous: Column, max_step: float = MAX_STEP,
                cap: float = MULTIPLIER_CAP) -> Column:
    """One step towards ``target``: capped, and at most ``max_step`` from ``previous``."""
    capped = F.least(target, F.lit(cap))
    moved = first_match([(capped - previous > max_step, previous + max_step),
                         (previous - capped > max_step, previous - max_step)], capped)
    return F.bround(F.least(F.coalesce(moved, capped), F.lit(cap)), 2)


def priced(demand: Column, supply: Column, rain: Column, temp: Column,
           previous: Column | None = None) -> dict[str, Column]:
    """All pricing columns of a row, by name."""
    ratio = demand_ratio(demand, supply)
    base, surcharge = base_multiplier(ratio), weather_surcharge(rain, temp)
    none = F.lit(None).cast("double")
    return {"ratio": F.bround(ratio, 3), "base_multiplier": base, "weather_adjustment": surcharge,
            "surge_multiplier": smooth_step(base + surcharge, none if previous is None else previous)}

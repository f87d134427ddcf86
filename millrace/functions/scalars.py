"""Scalar helpers: null handling, text, time and tariffs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.bands import first_match

# Fixed values.
MILES_TO_KM = 1.60934
PEAK_HOURS = (8, 9, 10, 17, 18, 19, 20)
PEAK_SPEED_KMPH, MIDDAY_SPEED_KMPH, FREE_SPEED_KMPH = 16.0, 22.0, 30.0
MIDDAY_HOURS = (11, 16)
# vehicle -> (base fare, fare per km)
TARIFF = {"Auto": (30.0, 12.0), "Bike": (20.0, 8.0), "Mini": (50.0, 13.0),
          "Sedan": (65.0, 16.0), "SUV": (90.0, 21.0)}


def not_blank(col: Column) -> Column:
    return col.isNotNull() & (F.length(F.trim(col)) > 0)


def number_or_zero(col: Column) -> Column:
    """Text to double; anything unreadable counts as zero."""
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def miles_to_km(col: Column) -> Column:
    return col.try_cast("double") * F.lit(MILES_TO_KM)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def minute_key(ts: Column) -> Column:
    """Minute as a sortable number, yyyyMMddHHmm."""
    return F.date_format(ts, "yyyyMMddHHmm").cast("bigint")


def store_key(zone: Column, ts: Column) -> Column:
    """Sortable key of a zone and minute: three digits, '#', yyyyMMddHHmm."""
    return F.concat(F.lpad(zone.cast("string"), 3, "0"), F.lit("#"),
                    F.date_format(ts, "yyyyMMddHHmm"))


def floor_to(ts: Column, seconds: int) -> Column:
    """Start of the bin of ``seconds`` that contains ``ts``."""
    epoch = F.unix_timestamp(ts)
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def is_peak(ts: Column) -> Column:
    return F.hour(ts).isin(*PEAK_HOURS)


def speed_kmph(hour: Column) -> Column:
    """Typical road speed for an hour of day."""
    return first_match([(hour.isin(*PEAK_HOURS), F.lit(PEAK_SPEED_KMPH)),
                        (hour.between(*MIDDAY_HOURS), F.lit(MIDDAY_SPEED_KMPH))],
                       F.lit(FREE_SPEED_KMPH))


def tariff_fare(vehicle: Column, km: Column, surge: Column) -> Column:
    """(base + per km x distance) x surge, two decimals; unknown vehicle -> null."""
    base = F.create_map(*[F.lit(x) for v, (b, _) in TARIFF.items() for x in (v, b)])
    per_km = F.create_map(*[F.lit(x) for v, (_, p) in TARIFF.items() for x in (v, p)])
    return F.bround((F.try_element_at(base, vehicle) + F.try_element_at(per_km, vehicle) * km) * surge, 2)


def matches_text(text: Column, wanted: Column | str) -> Column:
    """Case-insensitive substring test; a blank pattern matches nothing."""
    pattern = F.lower(F.trim(F.lit(wanted) if isinstance(wanted, str) else wanted))
    return (F.length(pattern) > 0) & F.contains(F.lower(text), pattern)

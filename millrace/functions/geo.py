"""Distances, bounding boxes and the zone dimension."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371
CITY_BOX = (17.10, 17.75, 78.15, 78.75)  # lat min, lat max, lon min, lon max
ZONE_ID_MIN, ZONE_ID_MAX = 1, 40
CITY = "Hyderabad"
ZONE_KINDS = ("business", "residential", "transit")


@dataclass(frozen=True)
class Zone:
    zone_id: int
    name: str
    kind: str
    lat: float
    lon: float
    weight: float


def make_zones(first: int = ZONE_ID_MIN, last: int = ZONE_ID_MAX) -> list[Zone]:
    """Zones on an 8-column lattice inside the city box, made from the id alone."""
    zones = []
    for z in range(first, last + 1):
        zones.append(Zone(z, f"Zone {z:02d}", ZONE_KINDS[z % 3],
                          (1720 + 10 * ((z - 1) // 8)) / 100,
                          (7820 + 6 * ((z - 1) % 8)) / 100,
                          (4 + z % 9) / 4))
    return zones


def zone_table(spark: SparkSession, zones: Sequence[Zone] | None = None) -> DataFrame:
    """The zone dimension: one row per zone, 40 by default."""
    rows = [(z.zone_id, z.name, z.kind, z.lat, z.lon, z.weight) for z in (zones or make_zones())]
    return spark.createDataFrame(
        rows, "zone_id int, zone_name string, kind string, latitude double, longitude double, demand_weight double")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    rad = F.lit(math.pi / 180)
    h = (F.lit(0.5) - F.cos((lat2 - lat1) * rad) / 2
         + F.cos(lat1 * rad) * F.cos(lat2 * rad) * (1 - F.cos((lon2 - lon1) * rad)) / 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(h))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float] = CITY_BOX) -> Column:
    lat_min, lat_max, lon_min, lon_max = box
    return lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max)


def nearest_zone(lat: Column, lon: Column, zones: Sequence[Zone]) -> Column:
    """Id of the closest zone; the lower id wins a tie.

    The zones are literals of the query, so the comparison runs inside the scan
    stage: no join, no shuffle.
    """
    shrink = F.cos(F.radians(lat))

    def squared(zone: Zone) -> Column:
        dy, dx = F.lit(zone.lat) - lat, (F.lit(zone.lon) - lon) * shrink
        return dy * dy + dx * dx

    in_order = sorted(zones, key=lambda z: z.zone_id)
    distances = F.array(*[squared(z) for z in in_order])
    place = F.array_position(distances, F.array_min(distances)).cast("int")
    return F.try_element_at(F.array(*[F.lit(z.zone_id) for z in in_order]), place)

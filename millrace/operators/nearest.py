"""Nearest places by grids of growing cells: equality joins, no comparison of every point with every place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import checkpointed

CROWD = 16      # aimed-at places in the fullest cell of the finest grid
HALVINGS = 12   # at most, towards that
BROADCAST_ROWS = 100_000  # counted rows that may be sent to every task


def squared(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Squared distance in degrees of latitude; degrees of longitude are narrowed as at the point."""
    dy, dx = to_lat - lat, (to_lon - lon) * F.cos(F.radians(lat))
    return dy * dy + dx * dx


def _cell(of: Column, size: float) -> Column:
    return F.floor(of / size).cast("bigint")


def _finest(places: DataFrame, n: int, height: float, width: float) -> float:
    """A cell size at which few places share a cell, also where they crowd."""
    size = max(math.sqrt(max(height, 1e-9) * max(width, 1e-9) / n), 1e-9)
    for _ in range(HALVINGS):
        crowd = places.groupBy(_cell(F.col("_y"), size), _cell(F.col("_x"), size)).count().agg(F.max("count")).first()[0]
        if crowd <= CROWD:
            break
        size /= 2
    return size


def _nine(df: DataFrame, y: str, x: str, size: float) -> DataFrame:
    """Every row once for its cell and for each of the eight around it."""
    near = [F.explode(F.array(*[_cell(F.col(c), size) + k for k in (-1, 0, 1)])) for c in (y, x)]
    return df.withColumn("_i", near[0]).withColumn("_j", near[1])


def _joinable(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a join: broadcast by its counted rows alone, not by the estimate that a plan has of its bytes."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def nearest(points: DataFrame, lat: str, lon: str, places: DataFrame, place: str, place_lat: str, place_lon: str) -> DataFrame:
    """``points`` with ``place``: the id of the nearest of ``places``, the lower id at a tie.

    Different positions are looked up once.  In a round, a position meets the
    places of its grid cell and of the eight around it; whichever side has fewer
    rows is the one repeated for nine cells.  A place outside of
    those is at least a cell's size away, so a nearer one is the answer; the
    positions left go on with cells twice as large, until one cell holds
    everything.  Null and NaN positions, and an empty ``places``, give null.
    """
    good = [F.col(c).isNotNull() & ~F.isnan(c) for c in (lat, lon)]
    left = checkpointed(points.where(good[0] & good[1]).select(
        F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")).distinct())
    known = checkpointed(places.where(f"{place_lat} IS NOT NULL AND {place_lon} IS NOT NULL").groupBy(
        F.col(place_lat).cast("double").alias("_y"), F.col(place_lon).cast("double").alias("_x")).agg(F.min(place).alias("_id")))
    ends = [f(c) for c in ("_y", "_x") for f in (F.min, F.max)]
    n, y0, y1, x0, x1 = known.agg(F.count(F.lit(1)), *ends).first()
    found = None
    if n:
        positions, p0, p1, q0, q1 = left.agg(F.count(F.lit(1)), *(f(c) for c in ("_lat", "_lon") for f in (F.min, F.max))).first()
        size = _finest(known, n, y1 - y0, x1 - x0)
        extent = 0.0 if p0 is None else max(max(y1, p1) - min(y0, p0), max(x1, q1) - min(x0, q0))
        m = positions
        while m:
            own = {"_i": _cell(F.col("_lat"), size), "_j": _cell(F.col("_lon"), size)}, {"_i": _cell(F.col("_y"), size), "_j": _cell(F.col("_x"), size)}
            if m <= n:
                met = known.withColumns(own[1]).join(_joinable(_nine(left, "_lat", "_lon", size), 9 * m), ["_i", "_j"])
            else:
                met = left.withColumns(own[0]).join(_joinable(_nine(known, "_y", "_x", size), 9 * n), ["_i", "_j"])
            far = squared(F.col("_lat"), F.col("_lon"), F.col("_y"), F.col("_x"))
            # Beside what they met, all positions once more: some meet nothing.
            met = met.select("_lat", "_lon", F.struct(far.alias("d"), "_id").alias("_met")).unionByName(left, allowMissingColumns=True)
            best = met.groupBy("_lat", "_lon").agg(F.min("_met").alias("_best"))
            sure = size * F.abs(F.cos(F.radians("_lat"))) * (1 - 1e-9)
            last = size >= extent
            round_ = checkpointed(best.withColumn("_done", F.lit(True) if last else F.coalesce(F.col("_best.d") < sure * sure, F.lit(False))))
            done = round_.where("_done").select("_lat", "_lon", F.col("_best._id").alias(place))
            found = done if found is None else found.unionAll(done)
            left = round_.where("NOT _done").select("_lat", "_lon")
            m = 0 if last else left.count()
            size *= 2
    if found is None:
        return points.withColumn(place, F.lit(None).cast(dict(places.dtypes)[place]))
    return (points.join(_joinable(found, positions), (F.col(lat).cast("double") == F.col("_lat")) & (F.col(lon).cast("double") == F.col("_lon")), "left")
            .drop("_lat", "_lon"))

"""Deduplication, set operations and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.aggregates import newest_per_key


# The unified stream: its kinds, and for each column beyond the common ones how a kind fills it.
COMMON = ("event_id", "event_time", "zone_id")
KINDS = {"request": {}, "ping": {"driver_id": F.col, "status": F.upper}}
EXTRA = ("driver_id", "status")


def _of_kind(df: DataFrame, kind: str) -> DataFrame:
    """The unified columns of one kind's events, without rows that have no zone or no readable time."""
    filled = [KINDS[kind][c](c).alias(c) if c in KINDS[kind] else F.lit(None).cast("string").alias(c) for c in EXTRA]
    # Streams carry the time as text; batch tables may already have it typed.
    text = dict(df.dtypes)["event_time"] == "string"
    time = F.try_to_timestamp("event_time") if text else F.col("event_time")
    whole = df.withColumn("event_time", time).dropna(subset=["event_time", "zone_id"])
    return whole.select(*COMMON, F.lit(kind).alias("kind"), *filled)


def union_events(requests: DataFrame, pings: DataFrame) -> DataFrame:
    """Requests and driver pings as one stream (or table) with a ``kind`` tag."""
    return _of_kind(requests, "request").unionAll(_of_kind(pings, "ping"))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, chosen by ``order`` (deterministic, unlike dropDuplicates)."""
    return newest_per_key(df, keys, order)


def upsert(current: DataFrame, changes: DataFrame, key: str, modified: str,
           tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Merge changed rows into a table with one row per key: the row modified last wins.

    A change replaces a current row of the same time.  The changes are reduced
    to one row per key; one full join then reads either side once.
    """
    best = dedup_latest(changes.select(*current.columns), [key], [F.desc(modified), *tiebreak])
    old, new = (df.select(key, F.struct(*current.columns).alias(name)) for df, name in ((current, "_old"), (best, "_new")))
    newer = F.coalesce(F.col(f"_new.{modified}") >= F.col(f"_old.{modified}"), F.col(f"_old.{modified}").isNull())
    kept = F.when(F.col("_new").isNotNull() & (F.col("_old").isNull() | newer), F.col("_new")).otherwise(F.col("_old"))
    return old.join(new, key, "full").select(kept.alias("_row")).select("_row.*")


def changed_since(df: DataFrame, modified: str, high_water: object) -> DataFrame:
    """Rows modified after the last import (all rows when there was none)."""
    return df if high_water is None else df.where(F.col(modified) > F.lit(high_water))

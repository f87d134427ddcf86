"""Row rules, reject accounting and table gates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.geo import ZONE_ID_MAX, ZONE_ID_MIN, CITY_BOX
from millrace.functions.scalars import not_blank
from millrace.operators.ordered import shifted
from millrace.session import checkpointed


class QualityError(Exception):
    """A gate found violations."""


@dataclass(frozen=True)
class Expectation:
    """A named row rule.  A row whose predicate is null violates it."""

    name: str
    predicate: Column
    action: str = "drop"  # drop | warn | fail

    def holds(self) -> Column:
        return F.coalesce(self.predicate, F.lit(False))


def all_hold(rules: Sequence[Expectation]) -> Column:
    condition = F.lit(True)
    for rule in rules:
        condition = condition & rule.holds()
    return condition


def apply_rules(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Keep the rows that meet every ``drop`` rule; a ``fail`` rule stops the job in the task."""
    fatal = [r for r in rules if r.action == "fail"]
    for rule in fatal:
        df = df.where(F.when(rule.holds(), F.lit(True))
                      .otherwise(F.raise_error(F.lit(f"expectation failed: {rule.name}")).cast("boolean")))
    return df.where(all_hold([r for r in rules if r.action == "drop"]))


def violation_report(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule with its violations, from a single pass over the data."""
    wide = df.agg(F.count(F.lit(1)).alias("checked"),
                  *[F.count_if(~r.holds()).alias(r.name) for r in rules])
    entries = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("violations"))
                        for r in rules])
    return (wide.select("checked", F.explode(entries).alias("e"))
            .select("e.rule", "checked", "e.violations"))


def reject_accounting(df: DataFrame, valid: Column) -> DataFrame:
    """Raw, valid and rejected row counts in one pass."""
    ok = F.coalesce(valid, F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(ok).alias("valid_rows"),
                  F.count_if(~ok).alias("rejected_rows"))


# ---- rule sets -----------------------------------------------------------

def transaction_rules() -> list[Expectation]:
    return [Expectation("transaction_id", not_blank(F.col("transaction_id"))),
            Expectation("customer_id", not_blank(F.col("customer_id"))),
            Expectation("category", not_blank(F.col("category"))),
            Expectation("transaction_time", F.col("transaction_time").isNotNull()),
            Expectation("amount", F.col("amount_value").isNotNull() & (F.col("amount_value") >= 0))]


def _fare_ok() -> Column:
    return F.col("fare").isNull() | (F.col("fare") >= 0)


def _order_ok() -> Column:
    return (F.col("pickup_time").isNull() | F.col("dropoff_time").isNull()
            | (F.col("dropoff_time") >= F.col("pickup_time")))


def _zone_in_range(name: str) -> Column:
    return F.coalesce(F.col(name).between(ZONE_ID_MIN, ZONE_ID_MAX), F.lit(False))


def trip_rules() -> list[Expectation]:
    """Zones in range, fare unknown or not negative, times in order."""
    return [Expectation("pickup_zone", _zone_in_range("pickup_zone_id")),
            Expectation("dropoff_zone", _zone_in_range("dropoff_zone_id")),
            Expectation("fare_not_negative", _fare_ok()),
            Expectation("dropoff_after_pickup", _order_ok())]


def warehouse_trip_rules() -> list[Expectation]:
    """As above, but a zone only has to be known."""
    return [Expectation("non_null_zone", F.col("pickup_zone_id").isNotNull() & F.col("dropoff_zone_id").isNotNull()),
            Expectation("fare_not_negative", _fare_ok()),
            Expectation("dropoff_after_pickup", _order_ok())]


def lake_trip_rules() -> list[Expectation]:
    """Warehouse rules plus: no pickup before the request."""
    zone, fare, order = warehouse_trip_rules()
    pickup = Expectation("pickup_after_request",
                         F.col("pickup_time").isNull() | (F.col("pickup_time") >= F.col("request_time")))
    return [zone, fare, pickup, order]


def lake_ping_rules(box: tuple[float, float, float, float] = CITY_BOX) -> list[Expectation]:
    lat_min, lat_max, lon_min, lon_max = box
    return [Expectation("valid_gps", F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max)),
            Expectation("non_null_zone", F.col("zone_id").isNotNull())]


# ---- table gates ---------------------------------------------------------

def kpi_gate_report(kpis: DataFrame) -> DataFrame:
    """Violations in an hourly KPI table; all zero means it may be published."""
    return kpis.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(F.col("pickup_zone_id").isNull()).alias("null_zone"),
        F.count_if(F.coalesce(F.col("completed") + F.col("cancelled") != F.col("requests"), F.lit(True)))
         .alias("unbalanced"),
        F.count_if(F.coalesce(F.col("requests") <= 0, F.lit(True))).alias("non_positive"))


def require_clean(report: DataFrame, ignore: Sequence[str] = ("rows_checked",)) -> None:
    """Raise when any counter of a one-row report is not zero."""
    row = report.first().asDict()
    bad = {k: v for k, v in row.items() if k not in ignore and v}
    if bad:
        raise QualityError(f"data quality gate failed: {bad}")


def silver_events(raw: DataFrame) -> DataFrame:
    """Requests with a zone in range and a readable time, one row per event id.

    Copies of an event are equal, so any of them may stay; the smallest is kept
    to make the result repeatable.
    """
    timed = raw
    if dict(raw.dtypes)["event_time"] == "string":
        timed = raw.withColumn("event_time", F.try_to_timestamp("event_time"))
    good = timed.where(_zone_in_range("zone_id") & F.col("event_time").isNotNull())
    return (good.groupBy("event_id").agg(F.min(F.struct("event_time", "zone_id")).alias("_e"))
            .select("event_id", "_e.event_time", "_e.zone_id"))


def reconcile_layers(raw: DataFrame) -> DataFrame:
    """raw - duplicates - invalid = silver, as one row of counts.

    Each event id is folded into one row first, so the counts need no distinct
    over the raw layer.  An id is invalid when none of its copies is usable.
    """
    usable = _zone_in_range("zone_id") & F.col("event_time").isNotNull()
    per_id = raw.groupBy("event_id").agg(F.count(F.lit(1)).alias("_copies"), F.count_if(usable).alias("_usable"))
    counts = per_id.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw_rows"),
                        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
                        F.count_if(F.col("_usable") == 0).alias("invalid"),
                        F.count_if(F.col("_usable") > 0).alias("silver_rows"))
    return counts.withColumn(
        "balanced", F.col("raw_rows") - F.col("duplicates") - F.col("invalid") == F.col("silver_rows"))


def batch_continuity(rows: DataFrame, batch: str, expected_rows: int) -> DataFrame:
    """Per batch id: its rows, the next id, and whether it is followed by a gap or short.

    The rows are counted once; only one row per batch is put in order.
    """
    sizes = checkpointed(rows.groupBy(batch).agg(F.count(F.lit(1)).alias("batch_rows")))
    return (shifted(sizes, [], [(batch, False)], batch, "next_batch", ahead=True)
            .withColumn("gap_after", F.coalesce(F.col("next_batch") != F.col(batch) + 1, F.lit(False)))
            .withColumn("wrong_size", F.col("batch_rows") != expected_rows))


def delivery_audit(archive: DataFrame, acked: Column | None = None, failed: Column | None = None) -> DataFrame:
    """Compare rows, offset span and distinct ids of an archived topic.

    Delivered exactly once means: no failure, and acknowledged = offset span =
    distinct ids.  ``acked`` defaults to the archived row count.
    """
    per_part = archive.groupBy("partition").agg(
        F.count(F.lit(1)).alias("_n"), (F.max("offset") - F.min("offset") + 1).alias("_span"))
    ids = archive.groupBy("event_id").agg(F.count(F.lit(1)).alias("_copies"))
    unique = ids.agg(F.count(F.lit(1)).alias("u")).scalar()
    out = per_part.agg(F.sum("_n").alias("archived_rows"), F.sum("_span").alias("offset_delta"))
    out = out.withColumn("unique_ids", unique)
    acked = F.col("archived_rows") if acked is None else acked
    failed = F.lit(0) if failed is None else failed
    return (out.withColumn("acked", acked.cast("bigint")).withColumn("failed", failed.cast("bigint"))
            .withColumn("exactly_once", (F.col("failed") == 0) & (F.col("acked") == F.col("offset_delta"))
                        & (F.col("offset_delta") == F.col("unique_ids"))))

"""Step-limited multipliers as a stateful stream, one state per zone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.pricing import LOOKBACK_STEPS, MAX_STEP, MULTIPLIER_CAP

OUTPUT = "zone_id int, window_end timestamp, surge_multiplier double, smoothed double"
# The last minute with its output, and the output it was computed from: a minute
# that arrives again is computed from the same predecessor.
STATE = "at timestamp, value double, before_at timestamp, before double"


def smooth(target: float, previous: float | None) -> float:
    capped = min(target, MULTIPLIER_CAP)
    if previous is not None:
        capped = max(min(capped, previous + MAX_STEP), previous - MAX_STEP)
    return round(min(capped, MULTIPLIER_CAP), 2)


def smoothed(rows: DataFrame, slide_seconds: int = 60) -> DataFrame:
    """Rows (zone_id, window_end, surge_multiplier) with the smoothed multiplier.

    Rows of a zone must arrive in time order across batches; one that is older
    than its zone's state keeps a null multiplier, for the reader to count.  The state is checkpointed by Spark, so a failed batch does not
    advance it.
    """
    lookback = pd.Timedelta(seconds=LOOKBACK_STEPS * slide_seconds)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("window_end")
        at, value, before_at, before = state.get if state.exists else (None, None, None, None)
        at, before_at = pd.Timestamp(at) if at is not None else None, pd.Timestamp(before_at) if before_at is not None else None
        out = []
        for time, target in zip(rows["window_end"], rows["surge_multiplier"]):
            if at is not None and time < at:
                out.append((key[0], time, target, None))
                continue
            if at is None or time > at:
                before_at, before = at, value
            near = before_at is not None and time - before_at <= lookback
            at, value = time, smooth(target, before if near else None)
            out.append((key[0], time, target, value))
        if at is not None:
            state.update((at, value, before_at, before))
        yield pd.DataFrame(out, columns=["zone_id", "window_end", "surge_multiplier", "smoothed"])

    return (rows.select("zone_id", "window_end", "surge_multiplier").groupBy("zone_id")
            .applyInPandasWithState(step, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout))

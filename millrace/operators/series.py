"""Time grids, lags and the step-limited recurrence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from millrace.session import checkpointed


def time_grid(counts: DataFrame, key: str, bin_col: str, value: str, seconds: int) -> DataFrame:
    """Every (key, bin) from the first to the last bin seen anywhere; gaps are zero.

    ``counts`` has one row per key and bin and is computed once: the raw events
    behind it are scanned a single time.  The range comes from a scalar subquery
    and each key unfolds its own bins, so nothing passes the driver.
    """
    counts = checkpointed(counts)
    ends = counts.agg(F.struct(F.min(bin_col).alias("first"), F.max(bin_col).alias("last")).alias("e")).scalar()
    step = F.make_dt_interval(secs=F.lit(seconds))
    grid = (counts.select(key).distinct()
            .select(key, F.explode(F.sequence(ends["first"], ends["last"], step)).alias(bin_col)))
    return (grid.join(counts, [key, bin_col], "left")
            .select(key, bin_col, F.coalesce(F.col(value), F.lit(0)).cast("double").alias(value)))


CHUNK_STEPS = 2048  # rows of a series in one window
LINKED = 64         # chunks of a recurrence that are composed in one task


def _chunked(df: DataFrame, key: str, order: str, seconds: int, back: int, ahead: int) -> tuple[DataFrame, WindowSpec]:
    """A gap-free series cut into chunks of CHUNK_STEPS rows, each with copies of its neighbours' edge rows.

    ``back`` and ``ahead`` say how far a row looks.  Windows then run on (key,
    chunk), so a long series is many tasks; rows with ``_own`` false are copies,
    to be dropped afterwards.
    """
    step = F.floor(F.unix_timestamp(order) / seconds)
    reach = F.sequence(F.floor((step - ahead) / CHUNK_STEPS), F.floor((step + back) / CHUNK_STEPS))
    rows = df.withColumn("_home", F.floor(step / CHUNK_STEPS)).withColumn("_chunk", F.explode(reach))
    return rows.withColumn("_own", F.col("_home") == F.col("_chunk")), Window.partitionBy(key, "_chunk").orderBy(order)


def with_lags(df: DataFrame, key: str, order: str, value: str, lags: dict[str, int], seconds: int) -> DataFrame:
    """Earlier (positive) or later (negative) values of a gap-free series with a row every ``seconds``."""
    rows, w = _chunked(df, key, order, seconds, max(0, *lags.values()), max(0, *(-n for n in lags.values())))
    made = {name: F.lag(value, n).over(w) if n > 0 else F.lead(value, -n).over(w) for name, n in lags.items()}
    return rows.withColumns(made).where("_own").drop("_home", "_chunk", "_own")


def with_rolling_means(df: DataFrame, key: str, order: str, value: str, sizes: dict[str, int],
                       seconds: int) -> DataFrame:
    """Mean of the last n rows of a gap-free series, null until n rows are there."""
    rows, w = _chunked(df, key, order, seconds, max(sizes.values()), 0)
    place = F.row_number().over(w)
    made = {name: F.when(place >= n, F.avg(value).over(w.rowsBetween(1 - n, 0))) for name, n in sizes.items()}
    return rows.withColumns(made).where("_own").drop("_home", "_chunk", "_own")


def step_limited(df: DataFrame, key: str, time: str, target: str, name: str,
                 step: Callable[[Column, Column], Column], lookback_seconds: int,
                 low: float, high: float, chunk_seconds: int = 86400, places: int = 2) -> DataFrame:
    """Each row moves from the previous *output* of its key towards ``target``.

    ``step(target, previous)`` gives the output, between ``low`` and ``high`` and
    rounded to ``places``; ``previous`` is null on a key's first row and after a
    gap of more than ``lookback_seconds``.  The frame has one row per key and
    time step, never raw events.

    The recurrence looks sequential, but time is cut into chunks that are folded
    side by side:

    * A chunk is folded from the lowest and from the highest value.  ``step``
      never lets two starting values cross, so where both end on one output that
      is the end of the chunk whatever came before.
    * Otherwise the chunk is folded from every value on the rounding grid, which
      gives its end as a table of its start.  A third end is that of a chunk
      whose first row begins afresh.
    * Such chunks compose: LINKED of them in a row are again a chunk with these
      ends.  Rounds of composing go up until a key has at most LINKED, and come
      down again with the start of each, so no task holds more than LINKED ends
      however long the series is.
    * Each chunk is folded once more from its start.
    """
    scale = 10 ** places
    first, last = round(low * scale), round(high * scale)
    grid = F.sequence(F.lit(first), F.lit(last))
    nothing = F.lit(None).cast("double")

    def ends(frame: DataFrame, end_from: Callable[[Column], Column], afresh: Column) -> DataFrame:
        return (frame.withColumns({"_end": end_from(F.lit(float(low))), "_fresh_end": afresh})
                .withColumn("_ends", F.when(F.col("_end") != end_from(F.lit(float(high))),
                                            F.transform(grid, lambda s: end_from(s.cast("double") / scale)))))

    def fold(start: Column) -> Column:
        return F.aggregate("_rows", start, lambda at, r: step(r[target], F.when(~r["_fresh"], at)))

    def late(since: Column, until: Column) -> Column:
        return F.coalesce(until - since > lookback_seconds, F.lit(False))

    seconds = F.unix_timestamp(time)
    listed = (df.select(key, F.floor(seconds / chunk_seconds).alias("_chunk"), F.struct(time, target, seconds.alias("_s")).alias("_r"))
              .groupBy(key, "_chunk").agg(F.sort_array(F.collect_list("_r")).alias("_in"))
              .withColumns({"_first": F.element_at("_in", 1)["_s"], "_last": F.element_at("_in", -1)["_s"],
                            # Whether a chunk's first row is fresh, the chunk before it tells.
                            "_rows": F.transform("_in", lambda r, i: F.struct(
                                r[time].alias(time), r[target].alias(target),
                                late(F.get("_in", i - 1)["_s"], r["_s"]).alias("_fresh")))}))
    chunks = checkpointed(ends(listed.drop("_in"), fold, fold(nothing)))

    def end_of(link: Column, start: Column, since: Column) -> Column:
        place = (F.rint(start * scale) - first + 1).cast("int")
        carried = F.when(link["_ends"].isNull(), link["_end"]).otherwise(F.element_at(link["_ends"], place))
        return F.when(begins(link, since), link["_fresh_end"]).otherwise(carried)

    def begins(link: Column, since: Column) -> Column:
        return since.isNull() | late(since, link["_first"])

    def through(start: Column, since: Column) -> Column:
        return F.aggregate("_links", F.struct(start.alias("at"), since.alias("since")),
                           lambda s, link: F.struct(end_of(link, s["at"], s["since"]).alias("at"), link["_last"].alias("since")),
                           lambda s: s["at"])

    linked = ("_chunk", "_first", "_last", "_end", "_fresh_end", "_ends")
    links = F.sort_array(F.collect_list(F.struct(*linked))).alias("_links")
    own_first = F.element_at("_links", 1)["_first"]

    def composed(parts: DataFrame) -> DataFrame:
        rows = (parts.groupBy(key, F.floor(F.col("_chunk") / LINKED).alias("_chunk")).agg(links)
                .withColumns({"_first": own_first, "_last": F.element_at("_links", -1)["_last"]}))
        return checkpointed(ends(rows, lambda start: through(start, own_first), through(nothing, F.lit(None).cast("bigint"))))

    def starts(groups: DataFrame) -> DataFrame:
        """(key, chunk, start) of the links of groups with a ``_start``, which is null where they begin afresh."""
        since = F.when(F.col("_start").isNotNull(), own_first)
        begun = F.aggregate(
            "_links", F.struct(F.col("_start").alias("at"), since.alias("since"), F.array().cast("array<double>").alias("out")),
            lambda s, link: F.struct(
                end_of(link, s["at"], s["since"]).alias("at"), link["_last"].alias("since"),
                F.concat(s["out"], F.array(F.when(~begins(link, s["since"]), s["at"]))).alias("out")),
            lambda s: s["out"])
        return (groups.select(key, F.explode(F.arrays_zip(F.col("_links._chunk").alias("c"), begun.alias("s"))).alias("_z"))
                .select(key, F.col("_z.c").alias("_chunk"), F.col("_z.s").alias("_start")))

    oldest, newest = chunks.agg(F.min("_chunk"), F.max("_chunk")).first()
    levels = [chunks]
    while oldest is not None and newest - oldest >= LINKED:
        levels.append(composed(levels[-1]))
        oldest, newest = oldest // LINKED, newest // LINKED
    found = starts(levels[-1].groupBy(key).agg(links).withColumn("_start", nothing))
    for groups in reversed(levels[1:]):
        found = starts(groups.select(key, "_chunk", "_links").join(found, [key, "_chunk"]))

    outputs = F.aggregate(
        "_rows", F.array("_start"),
        lambda done, r: F.concat(done, F.array(step(r[target], F.when(~r["_fresh"], F.element_at(done, -1))))))
    return (chunks.join(found, [key, "_chunk"])
            .select(key, F.explode(F.arrays_zip(F.col("_rows").alias("r"),
                                                F.slice(outputs, F.lit(2), F.size("_rows")).alias("o"))).alias("_z"))
            .select(key, F.col(f"_z.r.{time}").alias(time), F.col(f"_z.r.{target}").alias(target),
                    F.col("_z.o").alias(name)))

"""Events inside intervals of any begin and length, by time bins of a measured width."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def counted_within(intervals: DataFrame, events: DataFrame, key: str, begin: str, end: str, time: str,
                   name: str = "events") -> DataFrame:
    """Every different interval (key, begin, end) with the number of its key's events at begin <= time < end.

    Bins are as wide as the mean interval, so intervals unfold into about twice
    as many rows as there are intervals, however their lengths are spread.  Bins
    that an interval covers whole are joined with the events' number per bin;
    its first and last bin with the different times in them, which are compared.
    Both joins are equalities on (key, bin), so a hot key lies over its bins.
    Intervals that end before they begin, or have a null, hold nothing; null keys
    meet nothing.
    """
    spans = intervals.select(key, begin, end).distinct()
    micros = spans.withColumns({"_b": F.unix_micros(begin), "_e": F.unix_micros(end)}).where("_e > _b")
    mean = micros.agg(F.avg(F.col("_e") - F.col("_b"))).first()[0]
    if mean is None:
        return spans.withColumn(name, F.lit(0).cast("bigint"))
    width = max(1, round(mean))

    def bin_of(micro: str):
        return F.floor(F.col(micro) / width).cast("bigint")

    times = events.where(F.col(key).isNotNull()).groupBy(key, F.unix_micros(time).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n")).withColumn("_bin", bin_of("_t"))
    per_bin = times.groupBy(key, "_bin").agg(F.sum("_n").alias("_n"))
    unfolded = micros.withColumn("_last", F.col("_e") - 1).withColumn(
        "_bin", F.explode(F.sequence(bin_of("_b"), bin_of("_last"))))
    whole = (F.col("_bin") * width >= F.col("_b")) & ((F.col("_bin") + 1) * width <= F.col("_e"))
    inner = unfolded.where(whole).join(per_bin, [key, "_bin"]).select(key, begin, end, "_n")
    edges = unfolded.where(~whole).join(times, [key, "_bin"]).where("_t >= _b AND _t < _e").select(key, begin, end, "_n")
    held = inner.unionAll(edges).groupBy(key, begin, end).agg(F.sum("_n").alias(name))
    return spans.join(held, [key, begin, end], "left").withColumn(name, F.coalesce(name, F.lit(0)))

"""Aggregations: skew, ratios, rankings, lists and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from millrace.operators.ordered import numbered


def money(col: Column | str) -> Column:
    """Exact amount: sums of decimals do not depend on the order of the rows."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def cents(col: Column | str) -> Column:
    """An amount as whole cents: much cheaper to make from a double than a decimal with
    places, and its sums are exact and cannot overflow."""
    column = F.col(col) if isinstance(col, str) else col
    return F.rint(column.cast("double") * 100).cast("bigint").cast("decimal(18,0)")


def total(col: Column | str) -> Column:
    """Exact sum of an amount, handed back as a double."""
    return F.sum(cents(col)).cast("double") / 100


def mean(col: Column | str) -> Column:
    """Mean of an amount from its exact sum."""
    return total(col) / F.count(F.col(col) if isinstance(col, str) else col)


def subtotals(df: DataFrame, keys: Sequence[str], value: str, cube: bool = False,
              names: tuple[str, str, str] = ("level", "row_count", "total"), amounts: bool = True) -> DataFrame:
    """ROLLUP or CUBE counts and totals; ``level`` (grouping id) tells a total from a null key.

    ``amounts`` are summed as whole cents, other values as they are.

    Rows are aggregated by all keys first, so the grouping sets multiply only
    the groups and not the rows.
    """
    level, count, total_name = names
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(cents(value) if amounts else value).alias("_s"))
    sets = base.cube(*keys) if cube else base.rollup(*keys)
    return sets.agg(F.grouping_id().cast("bigint").alias(level), F.sum("_n").alias(count),
                    _handed_back(F.sum("_s"), amounts).alias(total_name))


def _handed_back(added: Column, amounts: bool) -> Column:
    return added.cast("double") / 100 if amounts else added


def salted_agg(df: DataFrame, key: str, value: str, salt: Column, salts: int,
               hot: Column | None = None, amounts: bool = True) -> DataFrame:
    """Two-phase count / sum / mean per key for a hot key.

    Rows for which ``hot`` holds are spread over ``salts`` sub-keys by ``salt``;
    the sub-totals are then added up, the mean from the added sums.
    """
    spread = F.pmod(salt, F.lit(salts))
    if hot is not None:
        spread = F.when(hot, spread).otherwise(F.lit(0))
    partial = (df.withColumn("_salt", spread).groupBy(key, "_salt")
               .agg(F.count(F.lit(1)).alias("_n"), F.sum(cents(value) if amounts else value).alias("_s")))
    return (partial.groupBy(key)
            .agg(F.sum("_n").alias("row_count"), _handed_back(F.sum("_s"), amounts).alias("total"))
            .withColumn("mean", F.col("total") / F.col("row_count")))


def share_percent(condition: Column) -> Column:
    """Rows meeting the condition, in percent of all rows; null on no rows."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count(F.lit(1)))


def rank_by_count(df: DataFrame, key: str, where: Column | None = None, name: str = "count") -> DataFrame:
    """Keys by how often they occur, most frequent first."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), key)


def chunked_lists(df: DataFrame, key: str, value: str, order: Sequence[tuple[str, bool]],
                  chunk: int = 1000) -> DataFrame:
    """All values of a key in order, as lists of at most ``chunk`` values; the contract is rows (key, part, values).

    A list per key would put a hot key into one row; here a key simply has as
    many rows (key, part, values) as it needs and no value is lost.
    """
    placed = numbered(df, [key], order, "_place")
    part = F.floor((F.col("_place") - 1) / chunk).cast("bigint")
    return (placed.groupBy(key, part.alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("_place", F.col(value).alias("v")))).alias("_list"))
            .select(key, "part", F.transform("_list", lambda e: e["v"]).alias("values")))


def counted(df: DataFrame, counters: Mapping[str, Column], name: str = "counters") -> tuple[DataFrame, Observation]:
    """Count beside a job: ``df`` with counters that fill while an action runs on it.

    Unlike accumulators they are not counted twice when a task is retried.
    """
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in counters.items()]), seen


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in ``order``.

    Spark cuts each map partition to ``n`` rows per key before the shuffle
    (window group limit), so a hot key ships few rows.
    """
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def top_by(df: DataFrame, metric: str, metrics: Mapping[str, str], key: str, n: int,
           max_n: int = 20) -> DataFrame:
    """The ``n`` rows with the highest metric; ``n`` is held to 1..max_n."""
    if metric not in metrics:
        raise ValueError(f"metric must be one of {sorted(metrics)}")
    column = metrics[metric]
    return df.orderBy(F.desc(column), key).limit(max(1, min(int(n), max_n)))

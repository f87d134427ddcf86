"""Ranking, lag/lead and running totals that survive a hot group.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task.  Here
the table is cut along the keys *and* the order, so a hot key lies over many
parts, and a window runs on (part, key).  What a key's earlier parts hold is
then added:

1. The cuts are rows of the table, taken from a sample by hash, and become a
   literal of the plan.  A row's part is found among them by halving, so it
   depends on the row alone: a task that runs again puts every row where it was,
   and no copy of the table has to pin the boundaries.
2. A key lies in more than one part only if a cut is a row of that key.  Only
   those keys need totals of their earlier parts, so that table has at most two
   rows for each cut, and is broadcast by that bound.

The sample reads the sorted columns, the totals read the rows of the cuts' keys,
and the rows themselves are shuffled once, while the result is made.

Ordering is Spark's own throughout: nulls, NaN, text and extreme numbers sort in
either direction as they do in a plain window.

The order must be unique within a group (name a tiebreak), except in
``ranked_by_value``, where equal values are meant to share a rank.  A frame that
gives other rows each time it is read must be written down before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import checkpointed

# (column name, descending)
Order = Sequence[tuple[str, bool]]

SAMPLED_PER_CUT = 32
_HASHES = 1 << 40
# Microseconds, which the default formats cut off.
_AS_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _order_by(order: Order) -> list[Column]:
    return [F.col(name).desc() if descending else F.col(name).asc() for name, descending in order]


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


@dataclass(frozen=True)
class Cuts:
    """``count`` rows at which a table is cut along ``keys`` and ``order``: a constant array of structs, sorted."""

    rows: Column
    count: int
    keys: Sequence[str]
    order: Order

    def _from_here(self, cut: Column) -> Column:
        """Whether a row stands at the cut or after it.

        Structs compare field by field with nulls first, as ascending sorts do;
        a descending sort is the exact reverse.
        """
        along = [*((k, False) for k in self.keys), *self.order]
        reached = F.lit(True)
        for descending, run in reversed([(d, list(g)) for d, g in groupby(enumerate(along), key=lambda c: c[1][1])]):
            theirs = F.struct(*[cut[f"c{i}"].alias(f"c{i}") for i, _ in run])
            mine = F.struct(*[F.col(name).alias(f"c{i}") for i, (name, _) in run])
            beyond = mine < theirs if descending else mine > theirs
            reached = beyond | ((mine == theirs) & reached)
        return reached

    def part(self) -> Column:
        """The number of cuts at or before a row, found by halving."""
        if not self.count:
            return F.lit(0)
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(self.count.bit_length()))])

        def step(found: Column, by: Column) -> Column:
            reached = (found + by <= self.count) & self._from_here(F.get(self.rows, found + by - 1))
            return F.when(reached, found + by).otherwise(found)

        return F.aggregate(steps, F.lit(0), step)

    def of_their_keys(self, df: DataFrame) -> DataFrame:
        """The rows of keys that can lie in more than one part, with ``_part``."""
        if self.keys:
            cut = df.sparkSession.range(1, numPartitions=1).select(F.explode(self.rows).alias("c"))
            own = cut.select(*[F.col("c")[f"c{i}"].alias(k) for i, k in enumerate(self.keys)]).distinct()
            # At most one key per cut.
            df = df.alias("l").join(F.broadcast(own.alias("r")), _same("l", "r", self.keys), "left_semi")
        return df.withColumn("_part", self.part())


def cuts_along(df: DataFrame, keys: Sequence[str], order: Order, parts: int | None = None) -> Cuts:
    """Cuts of ``df`` into about ``parts`` equal parts, as many as shuffles have by default.

    The sample is the rows with the smallest hashes, the same ones on every
    reading; it holds SAMPLED_PER_CUT rows for each cut, whatever the size of the
    table.  Rows alike in all sorted columns count once.  Only the cuts reach the
    driver, about one row for each part.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct(*[F.col(name).alias(f"c{i}") for i, name in enumerate([*keys, *(n for n, _ in order)])])
    share = F.lit(float(parts * SAMPLED_PER_CUT)) / df.agg(F.count(F.lit(1)).alias("n")).scalar()
    sample = (df.select(row.alias("c")).where(F.pmod(F.xxhash64("c"), F.lit(_HASHES)) < share * _HASHES)
              .groupBy("c").agg(F.lit(1).alias("one")))
    along = [F.col(f"c.c{i}").desc() if down else F.col(f"c.c{i}").asc()
             for i, down in enumerate([*(False for _ in keys), *(d for _, d in order)])]
    # The sample is bounded by its share, so one task may sort it.
    whole = Window.partitionBy("one")
    placed = sample.withColumns({"place": F.row_number().over(whole.orderBy(*along)), "size": F.count("c").over(whole)})
    cuts = placed.where(F.col("place") * parts % F.col("size") < parts).agg(F.sort_array(F.collect_list(F.struct("place", "c"))).alias("s"))
    cuts = cuts.select(F.struct(F.transform("s", lambda e: e["c"]).alias("cuts")).alias("found"))
    text, count = cuts.select(F.to_json("found", _AS_JSON), F.size("found.cuts")).first()
    return Cuts(F.from_json(F.lit(text), cuts.schema["found"].dataType, _AS_JSON)["cuts"], count, keys, order)


def _local(df: DataFrame, cuts: Cuts, local: Mapping[str, Column]) -> DataFrame:
    window = Window.partitionBy("_part", *cuts.keys).orderBy(*_order_by(cuts.order))
    return df.withColumn("_part", cuts.part()).withColumns(
        {"_at": F.row_number().over(window).cast("bigint"), **{name: column.over(window) for name, column in local.items()}})


def split_by_order(df: DataFrame, keys: Sequence[str], order: Order, local: Mapping[str, Column],
                   parts: int | None = None) -> DataFrame:
    """``df`` with ``_part``, the place of its part along the order, ``_at``, its row number inside
    (part, key), and ``local`` window columns."""
    return _local(df, cuts_along(df, keys, order, parts), local)


def _across(split: DataFrame, cuts: Cuts, totals: DataFrame, over_parts: Mapping[str, Column]) -> DataFrame:
    """``split`` with what the other parts of a row's key give it, as columns of ``over_parts``.

    ``totals`` has a row for every part that a cut's key lies in; ``over_parts``
    are taken along the parts of a key.
    """
    keys = cuts.keys
    found = totals.withColumns({"_parts": F.count(F.lit(1)).over(Window.partitionBy(*keys)), **over_parts})
    # Every row stands for a cut inside its key, so there are at most two per cut.
    found = found.where(F.col("_parts") > 1).select("_part", *keys, *over_parts)
    return (split.alias("l").join(F.broadcast(found.alias("r")), _same("l", "r", ["_part", *keys]), "left")
            .select("l.*", *[F.col(f"r.{n}") for n in over_parts]))


def _totals(df: DataFrame, cuts: Cuts, of_part: Mapping[str, Column]) -> DataFrame:
    return cuts.of_their_keys(df).groupBy("_part", *cuts.keys).agg(*[c.alias(n) for n, c in of_part.items()])


def _before(column: str, keys: Sequence[str]) -> Column:
    return F.sum(column).over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))


def numbered(df: DataFrame, keys: Sequence[str], order: Order, name: str = "row_number",
             parts: int | None = None) -> DataFrame:
    """Row number per group, from 1; ``keys`` may be empty for the whole table."""
    cuts = cuts_along(df, keys, order, parts)
    out = _across(_local(df, cuts, {}), cuts, _totals(df, cuts, {"_n": F.count(F.lit(1))}),
                  {"_before": _before("_n", keys)})
    return out.select(*df.columns, (F.col("_at") + F.coalesce("_before", F.lit(0))).alias(name))


def _added(local: Column, before: Column) -> Column:
    """A running sum and the sum before its part; null only while both are."""
    return F.when(before.isNull(), local).when(local.isNull(), before).otherwise(local + before)


def running_sum(df: DataFrame, keys: Sequence[str], order: Order, value: str, name: str,
                parts: int | None = None) -> DataFrame:
    """Sum of ``value`` from the first row of the group to this one (the order is unique)."""
    cuts = cuts_along(df, keys, order, parts)
    out = _across(_local(df, cuts, {"_local": F.sum(value)}), cuts, _totals(df, cuts, {"_s": F.sum(value)}),
                  {"_before": _before("_s", keys)})
    return out.select(*df.columns, _added(F.col("_local"), F.col("_before")).alias(name))


def shifted(df: DataFrame, keys: Sequence[str], order: Order, value: str, name: str,
            ahead: bool = False, parts: int | None = None) -> DataFrame:
    """Value of the previous row (``ahead=False``) or next row of the group."""
    cuts = cuts_along(df, keys, order, parts)
    near = F.lead(value) if ahead else F.lag(value)
    edge = F.lead(F.lit(False), 1, True) if ahead else F.lag(F.lit(False), 1, True)
    # What the neighbouring part needs is this part's first row, or its last; each task sends one per part and key.
    back = [(n, down if ahead else not down) for n, down in order]
    place = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*_order_by(back)))
    ends = (cuts.of_their_keys(df).withColumn("_place", place).where(F.col("_place") == 1)
            .select("_part", *keys, F.struct(F.col(value).alias("v")).alias("_held")))
    along = Window.partitionBy(*keys).orderBy("_part")
    out = _across(_local(df, cuts, {"_local": near, "_edge": edge}), cuts, ends,
                  {"_near": F.lead("_held").over(along) if ahead else F.lag("_held").over(along)})
    picked = F.when(F.col("_edge"), F.col("_near.v")).otherwise(F.col("_local"))
    return out.select(*df.columns, picked.alias(name))


def ranked_by_value(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True,
                    rank: str | None = "rank", dense_rank: str | None = None,
                    parts: int | None = None) -> DataFrame:
    """SQL ``rank`` / ``dense_rank`` by ``value``, where ties share a rank.

    Ranks depend only on how often each value occurs, so the values are counted
    first (partial counts on the map side) and the counts are ranked.  A value
    that fills a third of the table is one row there.
    """
    counts = checkpointed(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    cuts = cuts_along(counts, keys, [(value, descending)], parts)
    out = _across(_local(counts, cuts, {"_local": F.sum("_n")}), cuts,
                  _totals(counts, cuts, {"_s": F.sum("_n"), "_k": F.count(F.lit(1))}),
                  {"_rows": _before("_s", keys), "_values": _before("_k", keys)})
    made = {rank: F.col("_local") - F.col("_n") + 1 + F.coalesce("_rows", F.lit(0)),
            dense_rank: F.col("_at") + F.coalesce("_values", F.lit(0))}
    names = [c for c in (rank, dense_rank) if c is not None]
    ranks = out.select(*keys, value, *[made[c].alias(c) for c in names])
    return (df.alias("l").join(ranks.alias("r"), _same("l", "r", [*keys, value]), "inner")
            .select("l.*", *[F.col(f"r.{c}").alias(c) for c in names]))

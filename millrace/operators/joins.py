"""Joins with defaults, and outer joins that stay balanced when a key is hot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import checkpointed

PIECE = 250_000  # rows of a hot key that are joined in one task


def _outer(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    mine, theirs = ([c for c in side.columns if c not in on] for side in (left, right))
    return left.join(right, on, how).select(*on, *mine, *theirs)


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of the rows: at most ``1 / share`` of them, whatever the table."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") >= total * share).select(*on)


def _dealt(side: DataFrame, own: str, count: str, other: str, others: str) -> DataFrame:
    """Rows of hot keys, each in one of its key's ``count`` pieces and once for each of the ``others`` pieces.

    A row's piece depends on its values and on the input partition that it stands
    in, so a task that runs again deals its rows as before, and equal rows do not
    all meet.  Maps cannot be hashed and do not count.
    """
    values = [name for name, kind in side.dtypes if "map<" not in kind and name not in (count, others)]
    piece = F.pmod(F.xxhash64(F.spark_partition_id(), *values), F.col(count))
    return (side.withColumn(own, piece.cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop(count, others))


def hot_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                  hot: DataFrame | None = None) -> DataFrame:
    """Inner or outer join; each side is read once unless ``hot`` keys are given.

    AQE splits a hot partition on both sides of an inner join, but only on the
    preserved side of an outer join and not at all in a full join; and it goes by
    bytes, of which many like rows have few.  Where keys were measured hot
    (``hot_keys``, bounded by its share), their rows go apart: their matches by an
    inner join of pieces of at most about PIECE rows, in which every row of a
    key's left pieces meets every row of its right ones once.  Rows without a
    match, and those with a null key, are not joined at all.
    """
    on = list(on)
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join type: {how}")
    if hot is None:
        return _outer(left, right, on, how)
    marked = F.broadcast(hot.select(*on).distinct())
    counts = [side.join(marked, on, "left_semi").groupBy(*on).agg(F.count(F.lit(1)).alias(name))
              for side, name in ((left, "_lefts"), (right, "_rights"))]
    # No more rows than hot keys, and every one of them that either side has.
    plan = checkpointed(counts[0].join(counts[1], on, "full").select(
        *on, *[F.coalesce(F.ceil(F.col(name) / PIECE), F.lit(0)).cast("int").alias(name) for name in ("_lefts", "_rights")]))
    known = F.lit(True)
    for key in on:
        known = known & F.col(key).isNotNull()
    rest = [side.where(known).join(F.broadcast(plan.select(*on)), on, "left_anti") for side in (left, right)]
    parts = [_outer(*rest, on, how)]
    both = F.broadcast(plan.where("_lefts > 0 AND _rights > 0"))
    parts.append(_outer(_dealt(left.join(both, on), "_i", "_lefts", "_j", "_rights"),
                        _dealt(right.join(both, on), "_j", "_rights", "_i", "_lefts"),
                        [*on, "_i", "_j"], "inner").drop("_i", "_j"))
    for side, others, kinds in ((left, "_rights", ("left", "full")), (right, "_lefts", ("right", "full"))):
        if how in kinds:
            alone = F.broadcast(plan.where(F.col(others) == 0).select(*on, F.lit(True).alias("_alone")))
            parts.append(side.join(alone, on, "left").where(~known | F.col("_alone")).select(*side.columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def lookup(key: Column, names: Mapping[object, object], default: object = "Unknown") -> Column:
    """Literal map lookup for keys written in the program; a missing or null key gives ``default``.

    Keys that come from data are a table: use ``lookup_join``.
    """
    pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def lookup_join(df: DataFrame, names: DataFrame, key: str, value: str, default: object) -> DataFrame:
    """Left join to a keyed table, missing keys filled with ``default``; AQE chooses the join by the table's size."""
    return (df.join(names.select(key, value), key, "left")
            .withColumn(value, F.coalesce(F.col(value), F.lit(default))))


GRAMS = (1, 2, 3, 6)  # lengths of the pieces by which a term finds its candidates: the longest that fits


def _grams(text: str, sizes: Column) -> Column:
    """The different pieces of a text that have one of the lengths."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    pieces = F.flatten(F.transform(sizes, lambda n: F.filter(
        F.transform(at, lambda i: F.col(text).substr(i, n)), lambda g: F.length(g) == n)))
    return F.array_distinct(pieces)


def gram_pairs(terms: DataFrame, term: str, names: DataFrame) -> DataFrame:
    """(term, _text, _name, _found): every term beside the names that hold its rarest piece.

    The names' pieces are counted first, as far as terms ask for them; a term
    then probes with the one that fewest names have, so a beginning that all
    names share brings nobody together.  Names with the same text are one.
    """
    asked = terms.select(term, F.lower(F.trim(term)).alias("_text")).where(F.length("_text") > 0)
    longest = [F.when(F.length("_text") >= n, n) for n in reversed(GRAMS)]
    pieces = asked.withColumn("_gram", F.explode(_grams("_text", F.array(F.coalesce(*longest)))))
    texts = names.groupBy(F.lower("name").alias("_name")).agg(F.min("id").alias("_found"))
    index = texts.withColumn("_gram", F.explode(_grams("_name", F.array(*map(F.lit, GRAMS)))))
    counts = index.join(pieces.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = pieces.join(counts, "_gram", "left").groupBy(term, "_text").agg(
        F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    return rarest.join(index, "_gram").drop("_gram")


def resolved(terms: DataFrame, term: str, names: DataFrame) -> DataFrame:
    """Each distinct term with the lowest ``id`` of ``names`` (id, name) that it means, or null.

    A term that is an id means that row; else any name that contains it,
    whatever its case and padding.  Candidates are the names that hold the
    term's rarest piece, never all names.
    """
    asked = terms.select(term, F.lower(F.trim(term)).try_cast("bigint").alias("_id"))
    by_id = asked.join(names.select(F.col("id").alias("_id")).distinct(), "_id").select(term, F.col("_id").alias("_exact"))
    by_text = (gram_pairs(terms, term, names).where(F.contains("_name", "_text"))
               .groupBy(term).agg(F.min("_found").alias("_part")))
    return (asked.select(term).join(by_id, term, "left").join(by_text, term, "left")
            .select(term, F.coalesce("_exact", "_part").alias("id")))


def zero_filled(dimension: DataFrame, facts: DataFrame, on: str,
                defaults: Mapping[str, object]) -> DataFrame:
    """One row for every row of ``dimension``; absent facts take the defaults.

    ``facts`` has at most one row per key, so the join cannot fan out.
    """
    joined = dimension.join(facts, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_newest(df: DataFrame, readings: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
    """Attach the newest reading to every row; without readings the columns are null.

    The reading is one row, taken by an aggregate and used as a scalar subquery,
    so there is no join at all.
    """
    newest = readings.agg(F.max_by(F.struct(*columns), F.struct(time, *columns)).alias("r")).scalar()
    return (df.withColumn("_r", newest)
            .select(*df.columns, *[F.col(f"_r.{c}").alias(c) for c in columns]))


def windows_with_events(windows: DataFrame, events: DataFrame, key: str, end: str, time: str,
                        size_seconds: int, slide_seconds: int) -> DataFrame:
    """Join each window to the events of its key with ``end - size <= time < end``.

    Windows end on multiples of the slide, so an event belongs to exactly
    ``size / slide`` of them: events are counted per slide first, and the range
    condition becomes an equality on (key, slide start).  Returns one row per
    window with ``recounted``.
    """
    slide = F.lit(slide_seconds)
    epoch = F.unix_timestamp(F.col(time))
    panes = (events.groupBy(key, (epoch - F.pmod(epoch, slide)).alias("_pane"))
             .agg(F.count(F.lit(1)).alias("_n")))
    end_s = F.unix_timestamp(F.col(end))
    spread = windows.select(
        key, end, F.explode(F.sequence(end_s - size_seconds, end_s - slide_seconds, slide)).alias("_pane"))
    return (spread.join(panes, [key, "_pane"], "left")
            .groupBy(key, end).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("recounted")))

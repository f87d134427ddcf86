"""Mixing of sources to target weights: budgets go down a tree, documents are taken as prefixes of seeded epochs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import stored

UNKNOWN = "unknown"
WIDE = "decimal(38,0)"
DIGITS = 3  # of an order key that make its bucket: 4,096 per leaf


@dataclass(frozen=True)
class Level:
    """One level of the tree: its name, the SQL expression of a row's node, and whole-number weights by node.

    A node that ``weights`` does not name weighs ``other``; one of weight zero gets nothing.
    """

    name: str
    node: str
    weights: dict[str, int] = field(default_factory=dict)
    other: int = 1

    def weight_sql(self) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {w}" for k, w in self.weights.items())
        return f"CASE {self.name} {cases} ELSE {self.other} END" if cases else f"{self.other}"


@dataclass(frozen=True)
class Mix:
    """A tree of levels, the share of all tokens to hand out (in percent) and how often a document may come."""

    levels: tuple[Level, ...]
    percent: int = 100
    max_epochs: int = 4
    seed: int = 7

    @property
    def names(self) -> list[str]:
        return [level.name for level in self.levels]


def tokens_of(text: Column) -> Column:
    """A document's size: a token for every four code points begun."""
    return F.floor((F.char_length(F.coalesce(text, F.lit(""))) + 3) / 4).cast("bigint")


def order_key(mix: Mix, key: Column, epoch: Column) -> Column:
    """A document's place in an epoch; rows without a key share one place."""
    return F.md5(F.concat_ws("|", F.lit(mix.seed), epoch, key.cast("string")).cast("binary"))


def _nodes(mix: Mix) -> dict[str, Column]:
    return {level.name: F.coalesce(F.expr(level.node).cast("string"), F.lit(UNKNOWN)) for level in mix.levels}


def _shared(children: DataFrame, parent: list[str], weight: Column) -> DataFrame:
    """Gives each child its part of the parent's ``amount``: by weight, never above its ``cap``.

    Children are filled in the order of cap to weight.  One is full while its
    share of what is left would reach its cap; what the full ones leave over is
    shared by the rest, so siblings make up for each other before the parent's
    own share shrinks.  Whole numbers throughout.
    """
    rising = Window.partitionBy(*parent).orderBy(F.col("cap").cast("double") / F.col("w"), "node")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy(*parent)
    full = F.col("cap").cast(WIDE) * F.col("w_onward").cast("decimal(18,0)") <= (
        F.col("amount") - F.col("cap_before")).cast(WIDE) * F.col("w").cast("decimal(18,0)")
    left = F.col("amount") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everyone)
    heavy = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(everyone)
    return (children.withColumn("w", weight).filter(F.col("w") > 0)
            .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("w_onward", F.sum("w").over(onward))
            .withColumn("full", full)
            .withColumns({"left": left, "heavy": heavy})
            .withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(
                F.expr(f"cast(w as {WIDE}) * cast(left as decimal(18,0)) div heavy"))))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Leaves (the level names, ``size``) with the tokens each may give, ``budget``.

    The root has ``percent`` of all tokens, or what ``max_epochs`` of every
    document with a weight make, if that is less.
    """
    allowed = leaves.filter(" AND ".join(f"({level.weight_sql()}) > 0" for level in mix.levels))
    total = leaves.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * mix.percent // 100
    cap = (F.sum("size") * mix.max_epochs).cast("bigint")
    amounts, parent = None, []
    for level in mix.levels:
        here = [*parent, level.name]
        children = allowed.groupBy(*here).agg(cap.alias("cap")).withColumn("node", F.col(level.name))
        if amounts is None:
            children = children.withColumn("amount", F.least(F.lit(total), F.sum("cap").over(Window.partitionBy(F.lit(0)))))
        else:
            children = children.join(amounts, parent)
        filled = _shared(children, parent or [F.lit(0)], F.expr(level.weight_sql()))
        amounts, parent = filled.select(*here, F.col("got").cast("bigint").alias("amount")), here
    return allowed.join(amounts.withColumnRenamed("amount", "budget"), mix.names)


def plan(docs: DataFrame, mix: Mix, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sizes, shares): the key, nodes and tokens of every row, and what is taken of each leaf.

    A share is (nodes, size, budget, epochs, cut): ``epochs`` whole passes, and
    from the next one the documents whose order key is at most ``cut`` (null:
    none).  That prefix is the longest that stays within the budget; documents
    of one place come together or not at all.
    """
    sizes = stored(docs.select(F.col(key), *(c.alias(n) for n, c in _nodes(mix).items()),
                               tokens_of(F.col(text)).alias("tokens")))
    leaves = stored(sizes.groupBy(*mix.names).agg(F.sum("tokens").alias("size")))
    whole = F.when(F.col("size") > 0, F.expr("budget div size")).otherwise(0)
    shares = stored(budgets(leaves, mix).withColumn("epochs", whole)
                    .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("size")))
    # The running sum is taken over buckets of the order key, and inside the one bucket where it ends.
    placed = (sizes.join(shares, mix.names).filter(F.col("rest") > 0)
              .withColumn("place", order_key(mix, F.col(key), F.col("epochs") + 1))
              .withColumn("bucket", F.substring("place", 1, DIGITS)))
    by_bucket = placed.groupBy(*mix.names, "rest", "bucket").agg(F.sum("tokens").alias("n"))
    run = Window.partitionBy(*mix.names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (by_bucket.withColumn("until", F.sum("n").over(run))
            .filter((F.col("until") > F.col("rest")) & (F.col("until") - F.col("n") <= F.col("rest")))
            .select(*mix.names, "bucket", (F.col("until") - F.col("n")).alias("start")))
    inside = Window.partitionBy(*mix.names).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (placed.join(last, [*mix.names, "bucket"])
           .withColumn("until", F.col("start") + F.sum("tokens").over(inside))
           .filter(F.col("until") <= F.col("rest")).groupBy(*mix.names).agg(F.max("place").alias("inner_cut")))
    # If nothing of the last bucket fits, the prefix ends before it: below the bucket's own first place.
    ends = (last.join(cut, mix.names, "left")
            .select(*mix.names, F.coalesce("inner_cut", F.col("bucket")).alias("cut")))
    return sizes, stored(shares.join(ends, mix.names, "left").drop("rest"))


def _copies(rows: DataFrame, shares: DataFrame, mix: Mix, key: str) -> DataFrame:
    """Every row as often as its leaf's share says, numbered by ``epoch`` from 1."""
    last = F.col("epochs") + 1
    taken = F.col("cut").isNotNull() & (order_key(mix, F.col(key), last) <= F.col("cut"))
    times = F.col("epochs") + F.when(taken, 1).otherwise(0)
    return (rows.join(shares, mix.names).withColumn("times", times).filter(F.col("times") > 0)
            .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).drop("times"))


def selected(docs: DataFrame, mix: Mix, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, nodes, tokens, budget, epoch): one row for every copy of a document that the mix takes.

    Null nodes are UNKNOWN, null texts have no tokens.  Repeated rows are
    documents of their own that share a place.  An empty table gives no rows.
    """
    sizes, shares = plan(docs, mix, key, text)
    return _copies(sizes, shares, mix, key).select(key, *mix.names, "tokens", "budget", "epoch")


def mixed(docs: DataFrame, mix: Mix, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` as the mix takes them: rows repeat by epoch, all columns as they were.

    The texts are not shuffled to be chosen: a row's leaf and order key decide,
    and the table of leaves is joined.
    """
    _, shares = plan(docs, mix, key, text)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"),
                       *(c.alias(n) for n, c in _nodes(mix).items()))
    return _copies(rows, shares, mix, "_key").select("_row.*")


def mix_sql(mix: Mix, key: str = "doc_id", text: str = "text", table: str = "documents") -> str:
    """The rows of ``selected`` as SQL over whole tables, for comparison."""
    names = ", ".join(mix.names)
    nodes = ", ".join(f"coalesce(CAST({level.node} AS VARCHAR), '{UNKNOWN}') AS {level.name}" for level in mix.levels)
    allowed = " AND ".join(f"({level.weight_sql()}) > 0" for level in mix.levels)
    parts = [f"""
sizes AS (SELECT {key}, {nodes}, (length(coalesce({text}, '')) + 3) // 4 AS tokens FROM {table}),
leaves AS (SELECT {names}, sum(tokens)::HUGEINT AS size FROM sizes GROUP BY ALL),
allowed AS (SELECT * FROM leaves WHERE {allowed}),
level0 AS (SELECT least((SELECT coalesce(sum(size), 0)::HUGEINT * {mix.percent} // 100 FROM leaves),
                        (SELECT coalesce(sum(size), 0)::HUGEINT * {mix.max_epochs} FROM allowed)) AS amount)"""]
    parent: list[str] = []
    for i, level in enumerate(mix.levels):
        here = [*parent, level.name]
        keys, part = ", ".join(here), f"PARTITION BY {', '.join(parent)}" if parent else ""
        using = f"JOIN level{i} USING ({', '.join(parent)})" if parent else f"CROSS JOIN level{i}"
        parts.append(f"""
caps{i} AS (SELECT {keys}, sum(size)::HUGEINT * {mix.max_epochs} AS cap, ({level.weight_sql()})::HUGEINT AS w
            FROM allowed GROUP BY ALL),
rank{i} AS (SELECT *, coalesce(sum(cap) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS cap_before,
                   sum(w) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS w_onward
            FROM caps{i} {using} WINDOW rising AS ({part} ORDER BY cap::DOUBLE / w::DOUBLE, {level.name})),
full{i} AS (SELECT *, cap * w_onward <= (amount - cap_before) * w AS is_full FROM rank{i}),
level{i + 1} AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE
                   w * (amount - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({part})::HUGEINT)
                   // nullif(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({part})::HUGEINT, 0) END AS amount FROM full{i})""")
        parent = here
    parts.append(f"""
shares AS (SELECT {names}, size, amount AS budget, CASE WHEN size > 0 THEN amount // size ELSE 0 END AS epochs
           FROM allowed JOIN level{len(mix.levels)} USING ({names})),
placed AS (SELECT sizes.*, budget, epochs, budget - epochs * size AS rest,
                  md5(concat_ws('|', '{mix.seed}', (epochs + 1)::VARCHAR, {key}::VARCHAR)) AS place
           FROM sizes JOIN shares USING ({names})),
running AS (SELECT *, sum(tokens) OVER (PARTITION BY {names} ORDER BY place
                                        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until FROM placed),
times AS (SELECT *, (epochs + CASE WHEN rest > 0 AND until <= rest THEN 1 ELSE 0 END)::BIGINT AS n FROM running)
SELECT {key}, {names}, tokens, budget::BIGINT AS budget, unnest(range(1, n + 1)) AS epoch FROM times WHERE n > 0""")
    return "WITH " + ",".join(parts)

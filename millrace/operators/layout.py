"""Partitioning, plans and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return (df.select(F.spark_partition_id().alias("partition_id"))
            .groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows")))


def partition_count(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def spread(df: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """Repartition by count, or by columns into that many partitions."""
    return df.repartition(partitions, *columns)


def shrink(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(partitions)


def by_value(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with the same values brought together, a value that is too big for one task split by AQE.

    Dealt into no more partitions than a shuffle writes without sorting
    (``spark.shuffle.sort.bypassMergeThreshold``): a map task appends each row to its
    partition's file and neither holds nor spills its rows, whatever the input's splits.
    AQE splits what is large by then, so the tasks that follow stay small.
    """
    spark = df.sparkSession
    unsorted = int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return df.hint("rebalance", min(unsorted, int(spark.conf.get("spark.sql.shuffle.partitions"))), *columns)


def salted_repartition(df: DataFrame, partitions: int, key: str, salt: Column, salts: int,
                       hot: Column | None = None) -> DataFrame:
    """Repartition by key where a hot key is spread over ``salts`` partitions."""
    bucket = F.pmod(salt, F.lit(salts))
    if hot is not None:
        bucket = F.when(hot, bucket).otherwise(F.lit(0))
    return df.repartition(partitions, F.col(key), bucket)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints."""
    import io
    from contextlib import redirect_stdout

    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def preview(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """Schema and first rows, for people."""
    df.printSchema()
    df.show(n, truncate=truncate)


def require_columns(df: DataFrame, contract: Sequence[tuple[str, str]]) -> DataFrame:
    """Stop early when a frame does not have the agreed columns and types."""
    have = dict(df.dtypes)
    wrong = [(name, kind, have.get(name)) for name, kind in contract if have.get(name) != kind]
    if wrong:
        raise TypeError(f"schema contract broken (column, wanted, found): {wrong}")
    return df.select(*[name for name, _ in contract])


def salt_plan(df: DataFrame, key: str, partitions: int, most: int = 100) -> DataFrame:
    """(``key``, salts) of the values that hold more than a quarter of a partition's share of the rows.

    One pass with a sketch of the ``most`` commonest values finds them; each gets
    salts in proportion to its count, four for every partition that it fills.
    The plan has at most ``most`` rows, whatever the table.
    """
    found = df.agg(F.count(F.lit(1)).alias("_all"), F.expr(f"approx_top_k(`{key}`, {most}, {10 * most})").alias("_top"))
    salts = F.ceil(4 * partitions * F.col("t.count") / F.col("_all")).cast("int")
    return (found.select("_all", F.explode("_top").alias("t")).select(F.col("t.item").alias(key), salts.alias("salts"))
            .where("salts > 1"))


def planned_repartition(df: DataFrame, key: str, spread_by: Sequence[str], plan: DataFrame, partitions: int) -> DataFrame:
    """Repartition by ``key``; the rows of a value in ``plan`` are dealt over its salts by a hash of ``spread_by``."""
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_salts", F.lit(1)))
    marked = df.alias("l").join(F.broadcast(plan.select(F.col(key).alias("_key"), F.col("salts").alias("_salts"))),
                                F.col(key).eqNullSafe(F.col("_key")), "left")
    return marked.withColumn("_salt", salt).repartition(partitions, key, "_salt").select(*df.columns)

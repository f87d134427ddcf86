"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from millrace.session import shared_folder
from millrace.tables import read

# Texts are long: an Arrow batch of the default 10,000 rows could take gigabytes in a Python worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return read(spark, sf_dir, name)


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
           schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` over batches that stay small whatever the texts' lengths."""
    for key, value in BATCH.items():
        df.sparkSession.conf.set(key, value)
    return df.mapInArrow(function, schema)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back, its lineage cut.

    The folder is every executor's, so the rows outlive the executors that made
    them; it is deleted when the session ends.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A ``stored`` for the block: what it wrote is deleted at the end, so results must be stored elsewhere by then."""
    folder = shared_folder(spark, "scratch")
    places = iter(range(1 << 30))

    def store(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(places)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield store
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc(column: str | Column) -> Column:
    """crc32 of an id written as text."""
    return F.crc32((F.col(column) if isinstance(column, str) else column).cast("string").cast("binary"))


def sampled(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of each ``group``, those with the smallest hash of ``key``, with their ``place`` from 1.

    Groups are few by their meaning (labels, languages).  Their sizes are
    counted first and all but about ``4 n`` rows of a group are dropped by their
    hash where they are read, so a group's last ranking is small however many
    tasks read the table.  Null keys and groups take no part.
    """
    rows = rows.filter(F.col(key).isNotNull() & F.col(group).isNotNull())
    sizes = {r[group]: r["count"] for r in rows.groupBy(group).count().collect()}
    if not sizes:
        return rows.withColumn("place", F.lit(1))
    most = {g: -(1 << 63) + min((1 << 64) - 1, (1 << 64) * 4 * n // size) for g, size in sizes.items()}
    limits = F.create_map(*(F.lit(x) for pair in most.items() for x in pair))
    order = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    return (rows.filter(F.xxhash64(key) <= F.element_at(limits, F.col(group)))
            .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n))


def rank_within(df: DataFrame, group: str, order: str, sizes: DataFrame, rows_per_part: int = 1_000) -> DataFrame:
    """Adds ``rank`` (long, from 0): the row's place within its ``group``, without a window over a whole group.

    ``sizes`` has one row (group, n) per group, and is small by its meaning (a
    histogram).  A group is dealt by the hash of ``order`` into parts of about
    ``rows_per_part`` rows; a part's rows are numbered on their own, after the
    sum of the parts before it.  ``order`` is unique within a group.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / rows_per_part)).cast("bigint")
    dealt = (df.join(F.broadcast(sizes.select(group, parts.alias("_parts"))), group)
             .withColumn("_part", F.pmod(F.xxhash64(order), F.col("_parts"))))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
              .select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(group, "_part").orderBy(order)
    return (dealt.withColumn("_at", F.row_number().over(inside))
            .join(starts, [group, "_part"])
            .withColumn("rank", (F.col("_start") + F.col("_at") - 1).cast("bigint"))
            .drop("_part", "_parts", "_at", "_start"))

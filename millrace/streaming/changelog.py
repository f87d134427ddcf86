"""Update-mode output as a table: changes kept by batch, the newest of each key read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sinks.streams import BatchWriter, parquet_batch


def change_batch(path: str) -> BatchWriter:
    """Every batch's changed rows in a folder of their own, which a replay overwrites.  Nothing is read or merged here."""
    return parquet_batch(path)


def newest(changes: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """One row per key, that of the greatest ``version``.

    Combined before the shuffle, so a key that changes with every batch sends
    one row for each task that read its changes.  Null keys are keys.
    """
    values = [c for c in changes.columns if c not in (*keys, version)]
    return (changes.groupBy(*keys).agg(F.max_by(F.struct(*values), version).alias("_row"))
            .select(*keys, *(F.col("_row")[c].alias(c) for c in values)))


def read_changes(spark: SparkSession, path: str, schema: str, since: int | None = None) -> DataFrame:
    """The changes with their ``batch_id``; with ``since``, only folders of that batch and later are read."""
    changes = spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    return changes if since is None else changes.where(F.col("batch_id") >= since)


def compact(spark: SparkSession, path: str, target: str, schema: str, keys: Sequence[str]) -> int | None:
    """Write the newest row of each key below ``target`` as one batch, that of the last change, and return its id.

    Later changes are appended beside it and win by their batch id.
    """
    changes = read_changes(spark, path, schema)
    last = changes.agg(F.max("batch_id")).first()[0]
    if last is not None:
        newest(changes, keys).write.mode("overwrite").parquet(f"{target}/batch_id={last}")
    return last

"""Catalog tables over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def register_external(spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """External Parquet table with its columns taken from the files; partitions are discovered."""
    columns = spark.read.parquet(path).dtypes
    ddl = ", ".join(f"`{c}` {kind}" for c, kind in columns)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING PARQUET {parts} LOCATION '{path}'")
    if partition_by:
        repair(spark, name)


def repair(spark: SparkSession, name: str) -> None:
    """Make partitions that were written since known to the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df

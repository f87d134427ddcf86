"""Batch file writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.layout import by_value


def report_csv(df: DataFrame, path: str, files: int | None = 1) -> None:
    """CSV with a header in at most ``files`` files; None leaves the number to the result's partitions.

    One file is for reports that are small by their meaning; the caller decides.
    """
    (df if files is None else df.coalesce(files)).write.mode("overwrite").option("header", True).csv(path)


def partitioned_csv(df: DataFrame, path: str, *columns: str) -> None:
    df.write.mode("overwrite").option("header", True).partitionBy(*columns).csv(path)


def clustered_csv(df: DataFrame, path: str, *columns: str) -> None:
    """Partitioned CSV with few files per value: rows are brought together first, and the
    rebalance splits a value that is too big for one task."""
    partitioned_csv(by_value(df, *columns), path, *columns)


def parquet_tables(tables: Mapping[str, DataFrame], base: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")


def partitioned_parquet(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    by_value(df, *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def csv_copy(df: DataFrame, path: str, drop: Sequence[str] = ("city",)) -> None:
    """The row-format copy of a table that column scans are measured against."""
    df.drop(*drop).write.mode("overwrite").option("header", True).csv(path)


def scanned_bytes(df: DataFrame) -> int:
    """Size of the files a frame reads after partition pruning, from their metadata."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")).first()["bytes"]

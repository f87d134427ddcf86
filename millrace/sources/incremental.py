"""Imports into a Parquet table: full refresh and incremental merge."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.operators.dedup import changed_since, upsert
from millrace.sources.batch import parquet_or_empty

# A table lies in buckets by the hash of its key, one folder each; their number grows with the table, so that a bucket
# has about this many rows whatever its size.
BUCKET_ROWS = 1_000_000
FIRST_BUCKETS = 64  # of tables whose commits do not say
POINTER = "version bigint, high_water timestamp, folders map<int, bigint>, schema string, buckets int, sizes map<int, bigint>"


def full_refresh(tables: Mapping[str, DataFrame], base: str, files: int | None = None) -> None:
    """Replace every table by its source."""
    for name, df in tables.items():
        rows = df if files is None else df.coalesce(files)
        rows.write.mode("overwrite").parquet(f"{base}/{name}")


def _commit(spark: SparkSession, table: str, version: int | None = None) -> Row | None:
    """A committed version (the last one by default): its mark, and for each bucket the version that wrote it."""
    commits = parquet_or_empty(spark, f"{table}/commits", POINTER)
    if version is not None:
        commits = commits.where(F.col("version") == version)
    return commits.agg(F.max_by(F.struct(*commits.columns), "version").alias("c")).first()["c"]


def current_version(spark: SparkSession, table: str) -> tuple[int, object] | None:
    """The last committed version and its newest modification time."""
    last = _commit(spark, table)
    return None if last is None else (last["version"], last["high_water"])


def _rows(spark: SparkSession, table: str, commit: Row, buckets: Iterable[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets."""
    schema = StructType.fromJson(json.loads(commit["schema"]))
    wanted = commit["folders"] if buckets is None else {b: v for b, v in commit["folders"].items() if b in set(buckets)}
    paths = [f"{table}/data/v{version}/_bucket={bucket}" for bucket, version in sorted(wanted.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    commit = _commit(spark, table, version)
    if commit is None:
        raise FileNotFoundError(f"nothing imported into {table} yet" if version is None else f"{table} has no version {version}")
    return _rows(spark, table, commit)


def bucket_of(key: str, buckets: int) -> Column:
    """Linear hashing: the bucket of a key among ``buckets``, any number from 1.

    Buckets are split one after the other: bucket b takes rows from the bucket
    whose number is b without its highest bit, and no other row moves.
    """
    low = 1 << (buckets.bit_length() - 1)
    place = F.pmod(F.xxhash64(key), F.lit(2 * low))
    return F.when(place < buckets, place).otherwise(place - low).cast("int")


def split_from(bucket: int, buckets: int) -> int:
    """The bucket among ``buckets`` that holds the rows which go into ``bucket`` once there are more."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def bucket_sizes(spark: SparkSession, table: str, version: int | None = None) -> dict[int, int]:
    """Rows in each bucket of a version, as its commit states them."""
    commit = _commit(spark, table, version)
    return {} if commit is None else dict(commit["sizes"] or {})


def import_changes(spark: SparkSession, source: DataFrame, table: str, key: str, modified: str,
                   bucket_rows: int = BUCKET_ROWS) -> int:
    """Merge rows modified since the last import and commit a new version of the table.

    Only the buckets that hold a changed key, and those that are split because
    the table has grown, are read, merged and written again, beside the old
    ones; a version names for each bucket the folder it lies in.  There are as
    many buckets as the rows known and those arriving need at ``bucket_rows``
    each, so an import splits in proportion to its own rows.  It becomes current
    by one appended commit row, so readers never see half of it, and an import
    that dies is simply run again.
    """
    last = _commit(spark, table)
    version = 1 if last is None else last["version"] + 1
    folders, sizes = ({}, {}) if last is None else (dict(last["folders"]), dict(last["sizes"] or {}))
    buckets = 1 if last is None else last["buckets"] or FIRST_BUCKETS
    changes = changed_since(source, modified, None if last is None else last["high_water"])
    # At most a row per bucket: which change, how many rows arrive, and the newest time.
    seen = (changes.groupBy(bucket_of(key, buckets).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.max(modified).cast("timestamp").alias("m")).collect())
    mark = max([r["m"] for r in seen if r["m"] is not None], default=None if last is None else last["high_water"])
    if seen:
        rows = sum(sizes.values()) + sum(r["n"] for r in seen)
        grown = max(buckets, -(-rows // bucket_rows))
        touched = {r["b"] for r in seen} | {split_from(b, buckets) for b in range(buckets, grown)}
        merged = changes if last is None else upsert(_rows(spark, table, last, touched), changes, key, modified)
        path = f"{table}/data/v{version}"
        (merged.withColumn("_bucket", bucket_of(key, grown)).hint("rebalance", "_bucket")
         .write.mode("overwrite").partitionBy("_bucket").parquet(path))
        # Read from the files' footers.
        written = {r["b"]: r["n"] for r in spark.read.parquet(path).groupBy(F.col("_bucket").cast("int").alias("b"))
                   .agg(F.count(F.lit(1)).alias("n")).collect()}
        folders = {b: v for b, v in folders.items() if b not in touched} | dict.fromkeys(written, version)
        sizes = {b: n for b, n in sizes.items() if b not in touched} | written
        buckets = grown
    spark.createDataFrame([(version, mark, folders, source.schema.json(), buckets, sizes)], POINTER).coalesce(1) \
        .write.mode("append").parquet(f"{table}/commits")
    return version

"""Batch readers with pinned schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def csv_table(spark: SparkSession, path: str, schema: str | StructType | None, header: bool = True) -> DataFrame:
    """CSV with a pinned schema; ``schema=None`` infers it at the price of another pass."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def delimited_log(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A log without a header line; the schema names the columns."""
    return spark.read.schema(schema).option("sep", sep).csv(path, header=False)


def csv_as_text(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Every column as text, short or long lines tolerated: for input that must be validated."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.option("header", True).option("mode", "PERMISSIVE").schema(schema).csv(path)


def rows_table(spark: SparkSession, rows: Sequence[tuple], schema: str, slices: int | None = None) -> DataFrame:
    """Literal rows, dealt over ``slices`` partitions if that is given."""
    df = spark.createDataFrame(rows, schema)
    return df if slices is None else df.repartition(slices)


def generated(spark: SparkSession, first: int, last: int, columns: Mapping[str, object],
              partitions: int | None = None) -> DataFrame:
    """Ids ``first..last`` with derived columns, made on the executors."""
    return spark.range(first, last + 1, numPartitions=partitions).withColumns(dict(columns))


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parquet_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, column: str | None = None, low: object = None,
                 high: object = None, partitions: int = 1, fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read; with a numeric or date ``column`` it runs in ``partitions`` slices."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    options.update({k: v for k, v in (("user", user), ("password", password), ("driver", driver)) if v is not None})
    if column is not None:
        if low is None or high is None:
            raise ValueError("a partitioned read needs both bounds")
        options.update({"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                        "numPartitions": str(partitions)})
    return options


def jdbc_table(spark: SparkSession, **source) -> DataFrame:
    """A database table, read in parallel slices when a partition column is given."""
    return spark.read.format("jdbc").options(**jdbc_options(**source)).load()


def kafka_range(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", ending: str = "latest",
                since_ms: int | None = None) -> DataFrame:
    """A bounded read of a topic; ``since_ms`` reads only from that time on."""
    reader = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("endingOffsets", ending))
    if since_ms is None:
        reader = reader.option("startingOffsets", starting)
    else:
        reader = reader.option("startingTimestamp", str(since_ms)).option(
            "startingOffsetsByTimestampStrategy", "latest")
    return reader.load()


def newest_reading(readings: DataFrame, time: str = "event_time") -> DataFrame:
    """The one newest row of a small reference stream (weather)."""
    newest = F.max_by(F.struct(*readings.columns), F.struct(F.try_to_timestamp(F.col(time).cast("string"))))
    return readings.agg(newest.alias("r")).where(F.col("r").isNotNull()).select("r.*")

"""Streaming sources: Kafka topics and their file-backed twins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# A topic name in, a frame with a ``value`` column (and perhaps partition, offset) out.
TopicReader = Callable[[str], DataFrame]


def files(spark: SparkSession, kind: str, path: str, schema: str, files_per_trigger: int | None = None,
          **options: object) -> DataFrame:
    """New files of a folder (csv, json, parquet, text) as a stream; seen files are remembered."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.format(kind).load(path)


def csv_files(spark: SparkSession, path: str, schema: str, **options: object) -> DataFrame:
    return files(spark, "csv", path, schema, header=True, **options)


def json_files(spark: SparkSession, path: str, schema: str, **options: object) -> DataFrame:
    return files(spark, "json", path, schema, **options)


def parquet_files(spark: SparkSession, path: str, schema: str, **options: object) -> DataFrame:
    return files(spark, "parquet", path, schema, **options)


def kafka_topics(spark: SparkSession, servers: str, starting: str = "latest", fail_on_data_loss: bool = True,
                 max_offsets_per_trigger: int | None = None) -> TopicReader:
    def read(topic: str) -> DataFrame:
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic).option("startingOffsets", starting)
                  .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        return reader.load()
    return read


def file_topics(spark: SparkSession, base: str, files_per_trigger: int | None = None) -> TopicReader:
    """Topics as JSON files of (value, partition, offset) below ``base/<topic>``."""
    def read(topic: str) -> DataFrame:
        return files(spark, "json", f"{base}/{topic}", "value string, partition int, offset bigint", files_per_trigger)
    return read


def parsed(messages: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON payloads as columns; an unreadable payload gives nulls."""
    data = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(data.alias("data"), *keep).select("data.*", *keep)


def payloads(messages: DataFrame) -> DataFrame:
    """The raw payload as text, one column."""
    return messages.select(F.col("value").cast("string").alias("value"))


def typed_topics(reader: TopicReader, schemas: Mapping[str, str], keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    return {topic: parsed(reader(topic), schema, keep) for topic, schema in schemas.items()}

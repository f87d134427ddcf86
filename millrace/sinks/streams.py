"""Stream sinks and replay-safe batch writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]


def as_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, JSON value) text messages."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def start(df: DataFrame, sink: str | BatchWriter, mode: str = "append", checkpoint: str | None = None,
          interval: str | None = None, available_now: bool = False, name: str | None = None,
          options: Mapping[str, object] | None = None, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Start a stream into a named sink (console, memory, parquet, text, json, kafka) or a batch writer.

    ``interval`` gives a fixed trigger, ``available_now`` reads what is there and stops.
    """
    writer = df.writeStream.outputMode(mode)
    if name:
        writer = writer.queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return (writer.foreachBatch(sink) if callable(sink) else writer.format(sink)).start()


def console(df: DataFrame, mode: str, rows: int = 20, truncate: bool = False, **kwargs) -> StreamingQuery:
    return start(df, "console", mode, options={"numRows": rows, "truncate": str(truncate).lower()}, **kwargs)


def parquet_batch(path: str) -> BatchWriter:
    """Each batch overwrites its own folder, so a replayed batch changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop("batch_id") if "batch_id" in batch.columns else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
    return write


def delta_batch(path: str, app_id: str) -> BatchWriter:
    """Append to a Delta table; a replayed batch carries the same version and is skipped."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.format("delta").mode("append").option("txnAppId", app_id)
         .option("txnVersion", int(batch_id)).save(path))
    return write


def kafka_batch(servers: str, topic: str, key: str) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        (as_messages(batch, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
    return write


def json_batch(path: str, key: str) -> BatchWriter:
    """The same messages as ``kafka_batch``, as JSON files: the broker-free twin."""
    def write(batch: DataFrame, batch_id: int) -> None:
        as_messages(batch, key).write.mode("overwrite").json(f"{path}/batch_id={int(batch_id)}")
    return write


def fan_out(*writers: BatchWriter, prepare: Callable[[DataFrame, int], DataFrame] | None = None) -> BatchWriter:
    """Prepare a batch once, hold it, and hand it to every writer in order.

    An error in any writer fails the batch; Spark then replays it from the checkpoint.
    """
    from millrace.session import cached

    def write(batch: DataFrame, batch_id: int) -> None:
        # Held, because every further use would run the stateful stream plan again.
        with cached(batch) as held:
            if held.isEmpty():
                return
            rows = prepare(held, batch_id) if prepare else held
            with cached(rows) as ready:
                for writer in writers:
                    writer(ready, batch_id)
    return write

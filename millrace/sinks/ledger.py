"""Exactly-once delivery of micro-batches to several sinks, with a ledger of what is committed."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import cached
from millrace.sinks.streams import BatchWriter

ENTRIES = "sink string, rows bigint, batch_id bigint"

# Writes a batch into a folder that does not exist yet.
FolderWriter = Callable[[DataFrame, str], None]


def folder_writer(kind: str, **options: str) -> FolderWriter:
    def write(rows: DataFrame, path: str) -> None:
        rows.write.format(kind).options(**options).save(path)
    return write


@dataclass(frozen=True)
class Ledger:
    """The commits of one stream's batches: a small file for each (batch, sink) below ``path``."""

    spark: SparkSession
    path: str

    def _file(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))

    def _system(self):
        return self._file().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self, batch_id: int, sink: str) -> bool:
        return self._system().exists(self._file(f"batch_id={batch_id}", f"{sink}.json"))

    def commit(self, batch_id: int, sink: str, rows: int) -> None:
        """Enter a commit; a file appears under its name only once it is whole."""
        system, half = self._system(), self._file("_half", f"{batch_id}-{sink}")
        out = system.create(half, True)
        out.write(bytearray(json.dumps({"sink": sink, "rows": rows}).encode()))
        out.close()
        system.mkdirs(self._file(f"batch_id={batch_id}"))
        system.rename(half, self._file(f"batch_id={batch_id}", f"{sink}.json"))

    def table(self) -> DataFrame:
        """(sink, rows, batch_id) of every commit."""
        if not self._system().exists(self._file()):
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).json(self.path)


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    system, at = _place(spark, path)
    return system.exists(at)


def _delete(spark: SparkSession, path: str) -> None:
    system, at = _place(spark, path)
    system.delete(at, True)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Give a whole folder its name in one step."""
    system, to = _place(spark, target)
    system.mkdirs(to.getParent())
    if not system.rename(_place(spark, staged)[1], to):
        raise OSError(f"cannot publish {target}")


def batches_of(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """What is published below ``path``, with ``batch_id``."""
    return spark.read.format(kind).schema(f"{schema}, batch_id bigint").load(path)


def delivered(ledger: Ledger, sinks: Mapping[str, tuple[FolderWriter, str]],
              prepare: Callable[[DataFrame, int], DataFrame] | None = None) -> BatchWriter:
    """A batch writer that brings every batch to every sink once.

    ``sinks`` maps a name to (writer, folder).  A batch is written beside its
    sink, gets its place ``batch_id=N`` in one rename, and is then entered in the
    ledger.  A batch that died between two sinks is replayed by Spark under its
    id: committed sinks are passed over, a sink that was published but not yet
    entered is entered, the others are written.  Empty batches are entered too.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        left = [name for name in sinks if not ledger.committed(batch_id, name)]
        if not left:
            return
        # Held, because every further use would run the stateful stream plan again.
        with cached(batch) as held, cached(prepare(held, batch_id) if prepare else held) as rows:
            n = rows.count()
            for name in left:
                writer, folder = sinks[name]
                staged, target = f"{folder}/_staged/{batch_id}", f"{folder}/batch_id={batch_id}"
                if not _exists(ledger.spark, target):
                    _delete(ledger.spark, staged)  # what an attempt that died has left
                    writer(rows, staged)
                    publish(ledger.spark, staged, target)
                ledger.commit(batch_id, name, n)
    return write


def agreement(ledger: Ledger) -> DataFrame:
    """Per batch: sinks it reached and whether all of them hold as many rows."""
    return ledger.table().groupBy("batch_id").agg(
        F.count_distinct("sink").alias("sinks"), (F.min("rows") == F.max("rows")).alias("same_rows"), F.max("rows").alias("rows"))

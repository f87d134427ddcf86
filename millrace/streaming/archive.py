"""Landing streams as files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.streams import start
from millrace.sources.stream import TopicReader, payloads, typed_topics
from millrace.tables import DRIVER_PINGS, TRIP_REQUESTS, VISIT_EVENTS, WEATHER

RAW_TOPICS = {"trip_requests": TRIP_REQUESTS, "driver_gps_pings": DRIVER_PINGS, "weather": WEATHER}


def raw_text(messages: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds",
             available_now: bool = False) -> StreamingQuery:
    """Untouched payloads as text files."""
    return start(payloads(messages), "text", checkpoint=checkpoint, interval=interval,
                 available_now=available_now, options={"path": path})


def topics(reader: TopicReader, path: str, checkpoint: str, schemas: Mapping[str, str] = RAW_TOPICS,
           interval: str | None = "30 seconds", available_now: bool = False) -> dict[str, StreamingQuery]:
    """Every topic as Parquet with partition and offset, one query and checkpoint each."""
    frames = typed_topics(reader, schemas, keep=("partition", "offset"))
    return {topic: start(df, "parquet", checkpoint=f"{checkpoint}/{topic}", interval=interval, name=f"archive_{topic}",
                         available_now=available_now, options={"path": f"{path}/{topic}"})
            for topic, df in frames.items()}


def visits(reader: TopicReader, topic: str, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Visit events from a topic into a table; ``plans.visits`` queries it."""
    rows = typed_topics(reader, {topic: VISIT_EVENTS}, keep=("partition", "offset"))[topic]
    return start(rows, "parquet", checkpoint=checkpoint, options={"path": path}, **trigger)

"""Streaming sinks: Kafka topics per city, or message files where a path is given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transit_engine.sources.streams import to_messages, topic_of


def write_messages(
    messages: DataFrame,
    stage: str,
    checkpoint: str,
    path: str | None = None,
    servers: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Start the query that writes (city, vehicle_id, seq, value) messages.

    On Kafka the message key is the vehicle, so that one vehicle stays in one partition and in
    order. ``once`` takes what is there and stops.
    """
    if path:
        rows = messages.select("seq", "value")
        writer = rows.writeStream.format("parquet").option("path", path)
    else:
        rows = messages.select(
            topic_of(stage, F.col("city")).alias("topic"),
            F.concat_ws(":", "city", "vehicle_id").alias("key"),
            "value",
        )
        writer = rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_sink_raw(records: DataFrame, checkpoint: str, **target) -> StreamingQuery:
    """Normalised records -> the raw topics."""
    return write_messages(to_messages(records), "raw", checkpoint, **target)


def stream_sink_latest(accepted: DataFrame, checkpoint: str, **target) -> StreamingQuery:
    """Accepted messages -> the latest topics."""
    return write_messages(accepted, "latest", checkpoint, **target)

"""Message streams of live records.

A message is (``seq`` = its offset, ``value`` = JSON text). Kafka gives that directly; a file
source of the same two columns stands in for it elsewhere. What one trigger takes is capped, and
with it the rows any one vehicle can bring to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transit_engine.schemas import LIVE_RECORD

MESSAGE = "seq long, value string"
MAX_OFFSETS_PER_TRIGGER = 200_000
_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_REQUIRED = ["city", "vehicle_id", "latitude", "longitude"]


def raw_topic(city: str) -> str:
    return f"transit.live.raw.{city}.vehicles"


def latest_topic(city: str) -> str:
    return f"transit.live.latest.{city}.vehicles"


def topic_of(stage: str, city: Column) -> Column:
    """The topic name of a row's city; ``stage`` is ``raw`` or ``latest``."""
    return F.concat(F.lit(f"transit.live.{stage}."), city, F.lit(".vehicles"))


def _kafka(
    spark: SparkSession, topics: Sequence[str], servers: str, max_offsets: int | None
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "latest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("offset").alias("seq"), F.col("value").cast("string").alias("value")
    )


def _files(spark: SparkSession, path: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE).format("parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_raw(
    spark: SparkSession,
    cities: Sequence[str] = (),
    servers: str | None = None,
    path: str | None = None,
    files_per_trigger: int | None = 1,
    max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """New messages of the raw topics (``servers``), or of a folder of message files (``path``).

    None takes all there is with each trigger.
    """
    if path:
        return _files(spark, path, files_per_trigger)
    return _kafka(spark, [raw_topic(city) for city in cities], servers, max_offsets)


def stream_latest(
    spark: SparkSession,
    cities: Sequence[str] = (),
    servers: str | None = None,
    path: str | None = None,
    files_per_trigger: int | None = 1,
    max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """The accepted messages, as valid records; where to resume is in the query's checkpoint."""
    if path:
        return valid_records(_files(spark, path, files_per_trigger))
    return valid_records(
        _kafka(spark, [latest_topic(city) for city in cities], servers, max_offsets)
    )


def _parsed(messages: DataFrame) -> DataFrame:
    record = F.from_json("value", LIVE_RECORD).alias("record")
    return messages.select("seq", "value", record).select("seq", "value", "record.*").withColumn(
        "source", F.coalesce("source", F.lit("unknown"))
    )


def valid_records(messages: DataFrame) -> DataFrame:
    """Messages as records, in arrival order ``seq``; those without a required field are left out."""
    return _parsed(messages).drop("value").dropna(subset=_REQUIRED)


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The messages ``valid_records`` leaves out, as text."""
    missing = F.lit(False)
    for name in _REQUIRED:
        missing = missing | F.col(name).isNull()
    return _parsed(messages).where(missing).select("seq", "value")


def to_messages(records: DataFrame) -> DataFrame:
    """Records -> messages with their vehicle key; times keep their microseconds."""
    fields = [name for name in records.columns if name != "seq"]
    value = F.to_json(F.struct(*fields), {"timestampFormat": _TIME_FORMAT})
    return records.select("city", "vehicle_id", "seq", value.alias("value"))

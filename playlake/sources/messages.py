"""Event messages: JSON in a binary ``value`` with an arrival ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake import fixed
from playlake.schema import PAYLOAD_COLUMNS, PAYLOAD_DDL


def kafka_messages(spark: SparkSession, servers: str, topic: str = fixed.TOPIC, **options: str) -> DataFrame:
    """The topic as a stream, from its first offset, surviving expired offsets.

    Needs the Spark Kafka connector on the class path. Every other function
    only asks for a frame with ``value`` and ``timestamp``.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic), **options)
    return reader.load()


def kafka_options(servers: str, topic: str = fixed.TOPIC) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def parse_messages(messages: DataFrame) -> DataFrame:
    """Payload columns plus ``kafka_timestamp``. A malformed message gives nulls."""
    record = F.from_json(F.col("value").cast("string"), PAYLOAD_DDL).alias("record")
    arrived = F.col("timestamp").alias("kafka_timestamp")
    return messages.select(record, arrived).select("record.*", "kafka_timestamp")


def to_messages(events: DataFrame) -> DataFrame:
    """The reverse of :func:`parse_messages`, as a producer would send events."""
    value = F.to_json(F.struct(*PAYLOAD_COLUMNS)).cast("binary").alias("value")
    return events.select(value, F.col("kafka_timestamp").alias("timestamp"))

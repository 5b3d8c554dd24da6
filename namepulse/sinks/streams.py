"""Rows for Kafka topics and the writers that send them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..sources.streams import BROKERS


def record_messages(records: DataFrame, partition: int | None = None) -> DataFrame:
    """Keyed lines as Kafka rows. The event time goes into a header: the sink sets its own."""
    millis = F.unix_millis("timestamp").cast("string").cast("binary")
    header = F.struct(F.lit("event_ms").alias("key"), millis.alias("value"))
    columns = ["key", "value", F.array(header).alias("headers")]
    if partition is not None:
        columns.append(F.lit(partition).alias("partition"))
    return records.select(*columns)


def change_messages(changes: DataFrame) -> DataFrame:
    """Count changes as Kafka rows: the name is the key, JSON the value."""
    return changes.select(
        F.col("name").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def kafka_writer_options(
    topic: str, checkpoint: str | None = None, brokers: str = BROKERS
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": brokers, "topic": topic}
    if checkpoint is not None:
        options["checkpointLocation"] = checkpoint
    return options


def write_to_kafka(messages: DataFrame, options: dict[str, str]) -> None:
    messages.write.format("kafka").options(**options).save()


def stream_to_kafka(
    messages: DataFrame, options: dict[str, str], mode: str = "update"
) -> DataStreamWriter:
    """`options` from `kafka_writer_options`, with a checkpoint."""
    return messages.writeStream.format("kafka").outputMode(mode).options(**options)

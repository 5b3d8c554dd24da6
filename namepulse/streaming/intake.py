"""Segment files into a log of keyed, timed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from .. import schemas
from ..functions import text, times
from ..sources.segments import keyed_lines
from . import published, storage


def log_glob(root: str) -> str:
    """Path to read a published log from, once nobody writes to it; see `log_stream`."""
    return f"{root}/b*"


def log_stream(spark: SparkSession, root: str, starting: str = "earliest") -> DataFrame:
    """The lines of a published log as a stream: each batch once, when it is complete."""
    return published.stream(spark, root, schemas.RECORD_STREAM, starting)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The lines of the batches that are complete now."""
    return storage.read_versions(spark, root, schemas.RECORD_STREAM)


def intake(
    lines: DataFrame, root: str, checkpoint: str, minutes: int = times.SEGMENT_MINUTES
) -> DataStreamWriter:
    """Publish each batch of new segment files below `root`, times spread over the segment.

    `lines` comes from `sources.streams.segment_stream`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.withColumn(
            "value", text.drop_malformed_utf8("value")
        ).withColumn("line_id", F.monotonically_increasing_id())
        storage.publish(keyed_lines(ordered, minutes), root, batch_id)

    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)

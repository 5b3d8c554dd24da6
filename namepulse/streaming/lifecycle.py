"""Starting and stopping streaming queries."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions import times

STOP_SECONDS = 10
_STOP_TIMEOUT = "spark.sql.streaming.stopTimeout"


def per_second(writer: DataStreamWriter) -> DataStreamWriter:
    """One flush per second."""
    return writer.trigger(processingTime="1 second")


def per_segment(
    writer: DataStreamWriter, minutes: int = times.SEGMENT_MINUTES
) -> DataStreamWriter:
    """One intake per segment interval."""
    return writer.trigger(processingTime=f"{minutes} minutes")


def file_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append to Parquet files, each batch exactly once."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def run_available(writer: DataStreamWriter) -> None:
    """Process what is there and return."""
    writer.trigger(availableNow=True).start().awaitTermination()


def stop(query: StreamingQuery, seconds: int = STOP_SECONDS) -> bool:
    """Stop a query; False if it has not ended after `seconds`."""
    conf = SparkSession.active().conf
    before = conf.get(_STOP_TIMEOUT)
    conf.set(_STOP_TIMEOUT, f"{seconds}s")
    try:
        query.stop()
    except Py4JJavaError as e:
        if "TimeoutException" not in str(e.java_exception):
            raise
    finally:
        conf.set(_STOP_TIMEOUT, before)
    return not query.isActive

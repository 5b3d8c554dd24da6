"""Streaming (and batch) readers of record logs and count changes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schemas

# Fixed value: the topic names and broker used when none are given.
RECORD_TOPIC = "records"
COUNT_TOPIC = "name-counts"
BROKERS = "localhost:9092"


def kafka_options(
    topic: str,
    brokers: str = BROKERS,
    starting: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options; `starting` is 'earliest', 'latest' or JSON offsets."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "includeHeaders": "true",
    }
    if starting is not None:
        options["startingOffsets"] = starting
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def file_options(
    max_per_trigger: int | None = None, pattern: str | None = None
) -> dict[str, str]:
    """Reader options of file streams: intake limit and file name pattern."""
    options = {}
    if max_per_trigger is not None:
        options["maxFilesPerTrigger"] = str(max_per_trigger)
    if pattern is not None:
        options["pathGlobFilter"] = pattern
    return options


def _load(reader, format: str, options: Mapping[str, str], schema, path) -> DataFrame:
    reader = reader.format(format).options(**options)
    return reader.load() if format == "kafka" else reader.schema(schema).load(path)


def _records(reader, path, format, options) -> DataFrame:
    if format != "kafka":
        return _load(reader, format, options or {}, schemas.RECORD_STREAM, path)
    messages = _load(reader, format, options or kafka_options(RECORD_TOPIC), None, None)
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        event_time(messages).alias("timestamp"),
        F.col("offset"),
    )


def record_stream(
    spark: SparkSession,
    path: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keyed lines (key, value, timestamp, offset) as a stream, from files or Kafka."""
    return _records(spark.readStream, path, format, options)


def record_log(
    spark: SparkSession,
    path: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same log as a batch read."""
    return _records(spark.read, path, format, options)


def event_time(messages: DataFrame) -> Column:
    """Event time of a Kafka message: its `event_ms` header if it was read with headers."""
    if "headers" not in messages.columns:
        return F.col("timestamp")
    named = F.filter("headers", lambda h: h["key"] == "event_ms")
    millis = F.get(named, F.lit(0))["value"].cast("string").cast("bigint")
    return F.coalesce(F.timestamp_millis(millis), F.col("timestamp"))


def change_stream(
    spark: SparkSession,
    path: str | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Count changes from files or Kafka; Kafka starts at the newest unless told otherwise."""
    if format == "kafka":
        options = options or kafka_options(COUNT_TOPIC, starting="latest")
        return parse_changes(_load(spark.readStream, format, options, None, None))
    return _load(spark.readStream, format, options or {}, schemas.COUNT_CHANGES, path)


def parse_changes(messages: DataFrame) -> DataFrame:
    """Count changes from JSON values, as `sinks.streams.change_messages` writes them."""
    parsed = F.from_json(F.col("value").cast("string"), schemas.COUNT_CHANGES)
    return messages.select(parsed.alias("c")).select("c.*")


def segment_stream(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Lines of segment files as they appear; each file is taken once, in any order."""
    reader = spark.readStream.format("text").options(**(options or {}))
    return reader.load(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_block"),
    )


def write_slices(
    df: DataFrame, path: str, slice_of: Column, slices: int, then: Callable[[], None] | None = None
) -> None:
    """A table as files of a folder, one slice after the other: `slice_of` says which, from 0.

    `then` is called after each slice, as with a stream of the folder that processes what is
    there on one checkpoint; a slice is as many files as its rows came in. Without it a slice
    is one file, written by one task, and a stream with one file per trigger gets them in this
    order: for small tables only. df is computed once.
    """
    staged = f"{path.rstrip('/')}-staged"
    df.withColumn("_slice", slice_of).write.partitionBy("_slice").parquet(staged)
    schema = T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType())])
    numbered = df.sparkSession.read.schema(schema).parquet(staged)
    for k in range(slices):
        own = numbered.where(F.col("_slice") == k).drop("_slice")
        (own if then else own.coalesce(1)).write.mode("append").parquet(path)
        if then:
            then()


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream.

    The path is given as a pattern that only it matches: a plain path must be a folder.
    """
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).options(**(options or {})).parquet(pattern)

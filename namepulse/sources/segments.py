"""Segment files: index, listing, incremental intake and line times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import times
from ..functions.text import as_column, first_field
from ..operators.ranking import placed_in_order, position_in_group
from .records import read_positioned_lines, with_line_order

# How a segment file is named and found in an index line.
SEGMENT_EXTENSION = ".gkg.csv"
INDEX_PATH = r"/v2/gkg/[0-9]+\.gkg\.csv"
INDEX_NAME = r"[0-9]+\.gkg\.csv"

OFFSETS_PER_MINUTE = 1 << 32


def segment_index(
    lines: DataFrame,
    n: int,
    order: Sequence[str],
    value: str = "value",
    base: str = "",
    path_pattern: str = INDEX_PATH,
    name_pattern: str = INDEX_NAME,
) -> DataFrame:
    """(location, file_name) of the segments named in the first `n` index lines."""
    path = F.regexp_extract(value, path_pattern, 0)
    return (
        lines.orderBy(*order)
        .limit(n)
        .select(
            F.concat(F.lit(base), path).alias("location"),
            F.regexp_extract(path, name_pattern, 0).alias("file_name"),
            path.alias("_path"),
        )
        .where(F.col("_path") != "")
        .drop("_path")
    )


def read_segment_index(
    spark: SparkSession, path: str, n: int, base: str = ""
) -> DataFrame:
    lines = read_positioned_lines(spark, path)
    return segment_index(lines, n, ["file_path", "file_block", "line_id"], base=base)


def segments_in_window(
    df: DataFrame,
    now: Column | str,
    window_minutes: int = 60,
    minutes: int = times.SEGMENT_MINUTES,
    extension: str = SEGMENT_EXTENSION,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per segment file in the window that ends before `now`."""
    names = times.segment_names(now, window_minutes, minutes, extension)
    return df.select(*keep, F.explode(names).alias("file_name"))


def newer_than(
    df: DataFrame, high_water_mark: str, name: Column | str = "file_name"
) -> DataFrame:
    """Rows of segments named after the last one taken."""
    return df.where(as_column(name) > F.lit(high_water_mark))


def read_new_segments(
    spark: SparkSession, paths: str | Sequence[str], high_water_mark: str
) -> DataFrame:
    """Lines of the files named after the last one taken; older files are not opened."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    newer = newer_than(lines, high_water_mark, F.col("_metadata.file_name"))
    return with_line_order(newer)


def spread_event_times(
    lines: DataFrame,
    group: Sequence[str],
    chunk: Column | str,
    order: Sequence[str],
    start: Column,
    minutes: int = times.SEGMENT_MINUTES,
) -> DataFrame:
    """Add (position, total, first, event_ms): lines spread evenly over their segment.

    `start` is the segment start as the first line of each group gives it.
    """
    placed = position_in_group(lines, group, chunk, order, first=start)
    return placed.withColumn(
        "event_ms", times.spread_millis("first", "position", "total", minutes)
    )


def spread_in_order(
    lines: DataFrame,
    group: Sequence[str],
    order: str,
    start: Column,
    minutes: int = times.SEGMENT_MINUTES,
) -> DataFrame:
    """What `spread_event_times` adds, for lines of which one column tells the order."""
    placed = placed_in_order(lines, group, order, first=start)
    return placed.withColumn(
        "event_ms", times.spread_millis("first", "position", "total", minutes)
    )


def keyed_lines(
    lines: DataFrame, minutes: int = times.SEGMENT_MINUTES
) -> DataFrame:
    """Positioned lines of segment files as (key, value, timestamp, offset).

    The offset orders lines by segment start (in minutes) and position in the file.
    """
    timed = spread_event_times(
        lines,
        ["file_path"],
        "file_block",
        ["line_id"],
        times.segment_start_of_key("value"),
        minutes,
    )
    start_minute = F.unix_seconds("first") / 60
    return timed.select(
        first_field("value").alias("key"),
        "value",
        F.timestamp_millis("event_ms").alias("timestamp"),
        (start_minute.cast("bigint") * OFFSETS_PER_MINUTE + F.col("position")).alias(
            "offset"
        ),
    )

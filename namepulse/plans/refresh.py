"""Top names per day, kept up to date segment by segment.

A segment's counts per day and name are stored once, below `counts/segment=.../day=...`. When a
segment comes, late or again, only the days that it touches are added up and ranked anew, from
the stored counts, and only their partitions of `top` are overwritten. All of it can run again:
a segment that is added twice counts once, and one that fails in between is added again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import daily
from ..streaming.storage import delete, exists

COUNTS = "name string, count long, segment string, day string"
TOP = "rank long, name string, count long, day string"


def _counts(root: str) -> str:
    return f"{root}/counts"


def _top(root: str) -> str:
    return f"{root}/top"


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """(segment, day, name, count) of all segments; filters on segment and day pick the folders."""
    if not exists(spark, _counts(root)):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(_counts(root))


def read_top(spark: SparkSession, root: str) -> DataFrame:
    """(day, rank, name, count): the result as it is now."""
    found = spark.createDataFrame([], TOP) if not exists(spark, _top(root)) else spark.read.schema(TOP).parquet(_top(root))
    return found.select("day", "rank", "name", "count")


def _days(counts: DataFrame) -> set[str]:
    return {r["day"] for r in counts.select("day").distinct().collect()}  # as many as days


def add_segment(
    mentions: DataFrame, segment: str, root: str, n: int = daily.TOP_NAMES, ties: str = "all"
) -> set[str]:
    """Store a segment's (day, name) mentions and rank the days it touches; these days.

    A segment of that name that is there already is replaced.
    """
    spark = mentions.sparkSession
    before = _days(read_counts(spark, root).where(F.col("segment") == segment))
    stored = f"{_counts(root)}/segment={segment}"
    daily.daily_counts(mentions).write.mode("overwrite").partitionBy("day").parquet(stored)
    touched = before | _days(read_counts(spark, root).where(F.col("segment") == segment))
    rank_days(spark, root, touched, n, ties)
    return touched


def rank_days(
    spark: SparkSession, root: str, days: Iterable[str], n: int = daily.TOP_NAMES, ties: str = "all"
) -> None:
    """Rank some days anew from the stored counts; days without counts lose their result."""
    days = sorted(days)
    if not days:
        return
    counts = read_counts(spark, root).where(F.col("day").isin(days))
    summed = counts.groupBy("day", "name").agg(F.sum("count").alias("count"))
    # At most n rows a day: one file for each.
    daily.top_names(summed, n, ties).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("day").parquet(_top(root))
    for day in set(days) - _days(counts):
        delete(spark, f"{_top(root)}/day={day}")

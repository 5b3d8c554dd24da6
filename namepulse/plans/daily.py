"""Top names per day, from typed records and from plain lines."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import times
from ..operators import daily
from ..sinks.daily import write_result_lines
from ..sources.records import positional_records, read_lines


def record_mentions(
    records: DataFrame,
    day_format: str = times.DAY,
    exclude: Sequence[str] = daily.PARENT_CATEGORY,
    drop_empty: bool = False,
    keep_empty_days: bool = False,
) -> DataFrame:
    """(day, name) of typed records (`date`, `all_names`); no date or no names, no rows."""
    dated = records.where(
        F.col("all_names").isNotNull() & F.col("date").isNotNull()
    ).select(times.day_text("date", day_format).alias("day"), "all_names")
    return daily.mentions(
        dated,
        keep=["day"],
        exclude=exclude,
        drop_empty=drop_empty,
        keep_rows_without=keep_empty_days,
    )


def line_mentions(
    lines: DataFrame,
    day_format: str = times.DAY_FIRST,
    exclude: Sequence[str] = daily.CATEGORY,
    drop_empty: bool = False,
    keep_empty_days: bool = True,
) -> DataFrame:
    """(day, name) of tab-separated lines (`value`), taken by position."""
    dated = positional_records(lines).select(
        times.day_of_digits("date_digits", day_format).alias("day"), "all_names"
    )
    return daily.mentions(
        dated.where(F.col("day").isNotNull()),
        keep=["day"],
        exclude=exclude,
        drop_empty=drop_empty,
        keep_rows_without=keep_empty_days,
    )


def top_names_of_records(records: DataFrame, n: int = daily.TOP_NAMES, **options) -> DataFrame:
    """(day, rank, name, count) of typed records."""
    counts = daily.daily_counts(record_mentions(records, **options))
    return daily.top_names(counts, n)


def top_names_of_lines(
    lines: DataFrame,
    n: int = daily.TOP_NAMES,
    ties: str = "one_per_count",
    **options,
) -> DataFrame:
    """(day, rank, name, count) of plain lines; a day without names has rank and name NULL."""
    counts = daily.daily_counts(line_mentions(lines, **options))
    return daily.top_names(counts, n, ties)


def write_top_names_of_lines(
    spark: SparkSession, data_path: str | None = None, out_path: str | None = None
) -> None:
    """One text line per day; paths default to DATA_PATH and OUT_PATH of the environment."""
    lines = read_lines(spark, data_path or os.environ["DATA_PATH"], clean=False)
    pairs = daily.day_pairs(top_names_of_lines(lines))
    write_result_lines(pairs, out_path or os.environ["OUT_PATH"])

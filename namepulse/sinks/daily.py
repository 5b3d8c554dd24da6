"""Daily results as text lines and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import messages
from ..operators.daily import daily_documents


def result_lines(pairs: DataFrame) -> DataFrame:
    """(value): one `DateResult(...)` line per day."""
    return pairs.select(messages.day_result_line("day", "pairs").alias("value"))


def display_lines(pairs: DataFrame) -> DataFrame:
    """(value): one line per day for reading; show() it."""
    return pairs.select(messages.day_display_line("day", "pairs").alias("value"))


def write_result_lines(pairs: DataFrame, path: str, mode: str = "error") -> None:
    result_lines(pairs).write.mode(mode).text(path)


def write_daily_documents(pairs: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON document per day, one per line."""
    daily_documents(pairs).write.mode(mode).json(path)

"""Counts per segment interval of event time, each given once, when the watermark closes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import times
from ..operators.rolling import complete

# How many seconds behind the newest mention one may come and still count.
DELAY = times.WINDOW_SECONDS


def segment_counts(
    mentions: DataFrame, delay: int = DELAY, minutes: int = times.SEGMENT_MINUTES
) -> DataFrame:
    """(segment, name, count) of a stream of (name, timestamp), in append mode.

    A segment is given when the newest mention is `delay` seconds past its end, however its
    mentions were cut into batches; mentions that come later are dropped. Counts are partially
    aggregated before the shuffle, and state holds the open segments' names only.
    """
    found = complete(mentions).withWatermark("timestamp", f"{delay} seconds")
    counted = found.groupBy(F.window("timestamp", f"{minutes} minutes"), "name").count()
    return counted.select(times.segment_name("window.start").alias("segment"), "name", "count")

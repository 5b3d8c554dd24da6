"""Rolling one-hour counts over a stream of mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import times
from ..operators import daily
from ..operators.rolling import ADD, EXPIRE, complete
from ..sources.records import positional_records
from . import state

# How many seconds behind the newest mention of earlier batches one may come: a mention that
# still counts, of a segment that was filled in late, is not dropped.
DELAY = times.WINDOW_SECONDS + 60 * times.SEGMENT_MINUTES


def record_mentions(
    records: DataFrame, exclude: Sequence[str] = daily.CATEGORY
) -> DataFrame:
    """(key, timestamp, name) of keyed lines; batch or streaming."""
    keep = ["key", "timestamp"]
    return daily.mentions(
        positional_records(records, keep=keep), keep=keep, exclude=exclude, drop_empty=True
    )


def rolling_changes(
    mentions: DataFrame,
    delay: int = DELAY,
    window: int = times.WINDOW_SECONDS,
    mode: str = "append",
) -> DataFrame:
    """The streaming form of `operators.rolling.rolling_changes`.

    `mentions` is a stream of (name, timestamp). Mentions are added up per name and second
    before the shuffle, so the task that holds a name's state gets few rows however often
    the name occurs. Mentions more than `delay` seconds behind the newest second of earlier
    batches are dropped; Spark counts them as rows dropped by the watermark. All others count,
    in whatever order they come and however they are cut into batches.
    """
    sec = times.whole_seconds("timestamp")
    buckets = complete(mentions).select(
        "name",
        sec.alias("sec"),
        F.lit(1).cast("bigint").alias("n"),
        F.timestamp_seconds(sec).alias("timestamp"),
    ).mapInArrow(state.combine_buckets, state.BUCKET_COLUMNS)
    runs = (
        buckets.withWatermark("timestamp", f"{delay} seconds")
        .groupBy("name")
        .transformWithState(state.RollingCount(window, delay), state.RUN_COLUMNS, mode, "EventTime")
    )
    return changes_of(runs)


def changes_of(runs: DataFrame) -> DataFrame:
    """One row per change of the runs that `state.RollingCount` gives."""

    def change(sec: Column, at: Column) -> Column:
        before = F.coalesce(F.col("before") + F.get("counts", at - 1), "before")
        after = F.coalesce(F.col("before") + F.get("counts", at), "after")
        return F.struct(
            (F.col("sec") + sec).alias("event_sec"),
            F.when(after > before, ADD).otherwise(EXPIRE).alias("op"),
            before.alias("prev_count"),
            after.alias("count"),
            (F.col("seq") + at).alias("seq"),
        )

    return runs.select("name", F.inline(F.transform("secs", change)))

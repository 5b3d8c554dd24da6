"""Batch form of the rolling one-hour count per name.

A mention in second s counts from s to s + window - 1. In a second, expiries come before
new mentions. Input everywhere: one row per mention with `name` and `timestamp`; a row
without either is no mention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import times
from .ranking import order_runs

# A name's history is cut into blocks of this many seconds, one group each.
BLOCK_SECONDS = 86_400

# Mentions written out from one row of changes by one task.
PART_ROWS = 1 << 16

ADD, EXPIRE = "add", "expire"


def _running(
    buckets: DataFrame, window: int, block: int, within: list[str]
) -> DataFrame:
    """Running count after each bucket's start and expiry.

    `buckets`: (name, sec, *within, n). Returns (name, event_sec, *within, delta, count).
    The count is the running sum of +n at `sec` and -n at `sec + window`. Each block of a
    name is summed on its own: buckets that are live when a block begins are carried into
    it, so no group grows with a name's history.
    """
    if block < window:
        raise ValueError("block must be at least as long as the window")
    sec, n = F.col("sec"), F.col("n")
    start = F.floor(sec / block)
    end = sec + window

    def step(at: Column, block_no: Column, delta: Column, emit: bool) -> Column:
        return F.struct(
            at.alias("event_sec"),
            block_no.alias("_block"),
            delta.alias("delta"),
            F.lit(emit).alias("_emit"),
        )

    reaches_next = end >= (start + 1) * block
    steps = F.array(
        step(sec, start, n, True),
        step(end, F.floor(end / block), -n, True),
        F.when(reaches_next, step(sec, start + 1, n, False)),
    )
    events = (
        buckets.select("name", *within, F.explode(steps).alias("_s"))
        .where(F.col("_s").isNotNull())
        .select("name", *within, "_s.*")
    )
    in_order = (
        Window.partitionBy("name", "_block")
        .orderBy("event_sec", F.col("delta") > 0, *within)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        events.withColumn("count", F.sum("delta").over(in_order))
        .where("_emit")
        .select("name", "event_sec", *within, "delta", "count")
    )


def complete(mentions: DataFrame) -> DataFrame:
    """Mentions with a name and a time; batch or streaming."""
    return mentions.where(F.col("name").isNotNull() & F.col("timestamp").isNotNull())


def second_buckets(mentions: DataFrame) -> DataFrame:
    """(name, sec, n): mentions per name and second."""
    return (
        complete(mentions)
        .select("name", times.whole_seconds("timestamp").alias("sec"))
        .groupBy("name", "sec")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rolling_changes(
    mentions: DataFrame,
    window: int = times.WINDOW_SECONDS,
    block: int = BLOCK_SECONDS,
) -> DataFrame:
    """(name, event_sec, op, prev_count, count, seq): one row per change of a name's count.

    All mentions of a name in one second are one 'add' row; see `expand_changes`.
    """
    running = _running(second_buckets(mentions), window, block, [])
    added = F.col("delta") > 0
    return running.select(
        "name",
        "event_sec",
        F.when(added, ADD).otherwise(EXPIRE).alias("op"),
        (F.col("count") - F.col("delta")).alias("prev_count"),
        "count",
        # In a second, what expires goes before what is added.
        (F.col("event_sec") * 2 + added.cast("bigint")).alias("seq"),
    )


def expand_changes(changes: DataFrame, spread: bool = True) -> DataFrame:
    """(name, event_sec, op, count): one row per mention and one per expiry.

    Rows that stand for many mentions are first cut into parts; with `spread` the parts
    go to different tasks, so that one busy second is not written out by one task.
    """
    added = F.col("op") == ADD
    rows = F.when(added, F.col("count") - F.col("prev_count")).otherwise(F.lit(1))
    first = F.when(added, F.col("prev_count") + 1).otherwise(F.col("count"))
    last = first + rows - 1
    parts = changes.select(
        "name",
        "event_sec",
        "op",
        last.alias("_last"),
        F.explode(F.sequence(first, last, F.lit(PART_ROWS).cast("bigint"))).alias(
            "_first"
        ),
    )
    if spread:
        parts = parts.repartition("name", "event_sec", "_first")
    part_last = F.least(F.col("_first") + (PART_ROWS - 1), F.col("_last"))
    return parts.select(
        "name",
        "event_sec",
        "op",
        F.explode(F.sequence("_first", part_last)).alias("count"),
    )


def rolling_changelog(
    mentions: DataFrame,
    window: int = times.WINDOW_SECONDS,
    block: int = BLOCK_SECONDS,
) -> DataFrame:
    """(name, event_sec, op, count): every change of a rolling count, one row each."""
    return expand_changes(rolling_changes(mentions, window, block))


def rolling_adds(
    mentions: DataFrame,
    order: str,
    window: int = times.WINDOW_SECONDS,
    block: int = BLOCK_SECONDS,
) -> DataFrame:
    """(order, name, event_sec, count): each mention with the count that includes it.

    `order` is a unique integer column that orders the mentions of a second.
    """
    found = complete(mentions)
    rows = found.select(
        "name",
        times.whole_seconds("timestamp").alias("sec"),
        F.col(order),
        order_runs(found, order).alias("chunk"),
    )
    buckets = rows.groupBy("name", "sec", "chunk").agg(F.count(F.lit(1)).alias("n"))
    starts = (
        _running(buckets, window, block, ["chunk"])
        .where(F.col("delta") > 0)
        .select(
            "name",
            F.col("event_sec").alias("sec"),
            "chunk",
            (F.col("count") - F.col("delta")).alias("_before"),
        )
    )
    run = Window.partitionBy("name", "sec", "chunk").orderBy(order)
    return (
        rows.withColumn("_at", F.row_number().over(run))
        .join(starts, ["name", "sec", "chunk"])
        .select(
            order,
            "name",
            F.col("sec").alias("event_sec"),
            (F.col("_before") + F.col("_at")).alias("count"),
        )
    )


def histogram_as_of(
    mentions: DataFrame, at: str, window: int = times.WINDOW_SECONDS
) -> DataFrame:
    """(name, count) of the mentions that are live in the second of `at`."""
    moment = F.date_trunc("second", F.lit(at).cast("timestamp"))
    after = moment - F.make_dt_interval(secs=F.lit(window - 1))
    before = moment + F.make_dt_interval(secs=F.lit(1))
    return (
        complete(mentions)
        .where((F.col("timestamp") >= after) & (F.col("timestamp") < before))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def histogram_by_tick(
    mentions: DataFrame,
    step: int = times.SEGMENT_MINUTES * 60,
    window: int = times.WINDOW_SECONDS,
) -> DataFrame:
    """(tick, name, count): the live counts at every multiple of `step` seconds.

    Mentions are added up by the first tick they are live at; only these sums are counted at
    the other ticks.
    """
    if window % step:
        raise ValueError("step must divide the window")
    first = F.ceil(times.whole_seconds("timestamp") / step) * step
    sums = (
        complete(mentions)
        .select("name", first.alias("_first"))
        .groupBy("name", "_first")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    later = F.sequence(F.lit(0), F.lit(window - step), F.lit(step))
    ticks = sums.withColumn("_later", F.explode(later)).select(
        "name", "_n", (F.col("_first") + F.col("_later")).alias("tick")
    )
    return ticks.groupBy("tick", "name").agg(F.sum("_n").alias("count"))

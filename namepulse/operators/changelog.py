"""Top-K snapshots, their deltas, coalesced updates, messages, materialised logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import messages
from .ranking import top_in_group

LIVE_ENTRIES = 100


def top_k(counts: DataFrame, k: int = LIVE_ENTRIES) -> DataFrame:
    """The `k` names with the largest counts; names with count 0 are not held."""
    return (
        counts.where(F.col("count") > 0)
        .orderBy(F.col("count").desc(), "name")
        .limit(k)
    )


def top_k_by_tick(counts: DataFrame, k: int = LIVE_ENTRIES) -> DataFrame:
    """(tick, name, count, rank): the `k` largest counts at each tick."""
    order = [F.col("count").desc(), F.col("name")]
    return top_in_group(counts, ["tick"], order, k)


def tick_deltas(snapshots: DataFrame, step: int) -> DataFrame:
    """(tick, name, count): what changed since the snapshot one `step` earlier.

    A name that left the snapshot has count 0. Every snapshot row is one tick's new value
    and the next tick's old value, so the two meet in one grouping without a self-join.
    """
    nothing = F.lit(None).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("tick").alias("tick"),
            F.col("count").alias("new"),
            nothing.alias("old"),
        ),
        F.struct(
            (F.col("tick") + step).alias("tick"),
            nothing.alias("new"),
            F.col("count").alias("old"),
        ),
    )
    return (
        snapshots.select("name", F.explode(sides).alias("_s"))
        .groupBy("_s.tick", "name")
        .agg(F.max("_s.new").alias("new"), F.max("_s.old").alias("old"))
        .where(~F.col("new").eqNullSafe(F.col("old")))
        .select("tick", "name", F.coalesce("new", F.lit(0)).alias("count"))
    )


def snapshot_bounds(snapshots: DataFrame, *keys: str) -> DataFrame:
    """Entries held and the entry with the lowest count (first in name order on ties)."""
    lowest = F.min(F.struct("count", "name"))
    return (
        snapshots.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("entries"), lowest.alias("_low"))
        .select(
            *keys,
            "entries",
            F.col("_low.name").alias("min_name"),
            F.col("_low.count").alias("min_count"),
        )
    )


def latest_counts(changes: DataFrame) -> DataFrame:
    """(name, count): the newest count of each name."""
    return changes.groupBy("name").agg(
        F.max_by("count", "seq").alias("count")
    )


def coalesced_updates(changes: DataFrame, flush_seconds: int = 1) -> DataFrame:
    """(flush_sec, name, count): the newest count of each name in each flush interval."""
    sec = F.col("event_sec")
    return changes.groupBy(
        (sec - F.pmod(sec, F.lit(flush_seconds))).alias("flush_sec"), "name"
    ).agg(F.max_by("count", "seq").alias("count"))


def update_messages(updates: DataFrame, *keys: str) -> DataFrame:
    """(keys, message): one JSON array per key; no row where nothing changed.

    Meant for top-K deltas: at most 2 K entries per key.
    """
    entries = F.collect_list(F.struct("name", "count"))
    return (
        updates.groupBy(*keys)
        .agg(entries.alias("_updates"))
        .select(*keys, messages.update_message("_updates").alias("message"))
    )


def parse_messages(df: DataFrame, *keep: str, message: str = "message") -> DataFrame:
    """The single updates of JSON messages."""
    return df.select(
        *keep, F.inline(messages.parse_updates(message)).alias("name", "count")
    )


def materialise(changelog: DataFrame, order: str) -> DataFrame:
    """(name, count): newest value of each name by a unique integer; 0 deletes the name."""
    return (
        changelog.groupBy("name")
        .agg(F.max_by("count", order).alias("count"))
        .where(F.col("count") != 0)
    )


def increment_totals(updates: DataFrame) -> DataFrame:
    """(name, count): sum of the increments of each name; batch or streaming."""
    return updates.groupBy("name").agg(F.sum("increment").alias("count"))


def ordered_snapshot(
    snapshot: DataFrame, by: str = "count", order: str = "desc"
) -> DataFrame:
    """A snapshot ordered by name or count."""
    if by not in ("name", "count") or order not in ("asc", "desc"):
        raise ValueError("by is 'name' or 'count', order is 'asc' or 'desc'")
    first = F.col(by).asc() if order == "asc" else F.col(by).desc()
    return snapshot.orderBy(first) if by == "name" else snapshot.orderBy(first, "name")

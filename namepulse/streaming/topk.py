"""Live top K: a snapshot of bounded size, its deltas, and the JSON messages.

Names are dealt to shards, each of which keeps its counts and its own K largest in Spark's
state store and gives them when they change. A batch merges the shards' entries, SHARDS * K at
most, into the snapshot, so what it writes follows the names that it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import changelog
from . import state, storage

# Shards that live names are dealt to; it stays the same for a checkpoint's whole life.
SHARDS = 32

CHANGES = "shard int, name string, count long, seq long"
TOPS = "shard int, name string, count long"
COUNTS = "name string, count long, seq long"
SNAPSHOT = "name string, count long"
DELTAS = "block long, batch_id long, name string, count long"

# Seconds that earlier snapshots are kept for readers that are still on them.
KEEP_SECONDS = 600.0

# Deltas of so many batches share a folder.
BLOCK_BATCHES = 3_600


def _counts(root: str) -> str:
    return f"{root}/counts"


def _changed(root: str) -> str:
    return f"{root}/changed"


def _tops(root: str) -> str:
    return f"{root}/tops"


def _snapshots(root: str) -> str:
    return f"{root}/snapshots"


def _deltas(root: str) -> str:
    return f"{root}/deltas"


def next_counts(old: DataFrame, changes: DataFrame) -> DataFrame:
    """(name, count, seq) of all names that are live after some changes, in one grouping."""
    entries = old.select("name", "count", "seq").unionByName(changes.select("name", "count", "seq"))
    return (
        entries.groupBy("name")
        .agg(F.max_by("count", "seq").alias("count"), F.max("seq").alias("seq"))
        .where(F.col("count") > 0)
    )


def snapshot_deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name, count): what turns the old snapshot into the new; count 0 removes a name.

    Both have K rows at most, so they meet in one task, without a shuffle.
    """
    none = F.lit(None).cast("bigint")
    sides = new.select("name", F.col("count").alias("_new"), none.alias("_old")).unionByName(
        old.select("name", none.alias("_new"), F.col("count").alias("_old"))
    )
    return (
        sides.coalesce(1)
        .groupBy("name")
        .agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
        .where(~F.col("_new").eqNullSafe(F.col("_old")))
        .select("name", F.coalesce("_new", F.lit(0)).cast("bigint").alias("count"))
    )


def _version(spark: SparkSession, root: str, batch_id: int | None, schema: str) -> DataFrame:
    if batch_id is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(storage.version_path(root, batch_id))


def _publish(spark: SparkSession, snapshot: DataFrame, last: int | None, batch_id: int, root: str) -> None:
    """Write a batch's snapshot, and what turns the one of batch `last` into it."""
    target = storage.version_path(_snapshots(root), batch_id)
    snapshot.coalesce(1).write.mode("overwrite").parquet(target)
    new = _version(spark, _snapshots(root), batch_id, SNAPSHOT)
    deltas = snapshot_deltas(_version(spark, _snapshots(root), last, SNAPSHOT), new)
    block, batch = (F.lit(n).cast("bigint") for n in (batch_id // BLOCK_BATCHES, batch_id))
    deltas.select(block.alias("block"), batch.alias("batch_id"), "name", "count").write.mode(
        "append"
    ).partitionBy("block").parquet(_deltas(root))


def update_snapshot(
    changes: DataFrame,
    batch_id: int,
    root: str,
    k: int = changelog.LIVE_ENTRIES,
    keep_seconds: float = KEEP_SECONDS,
) -> None:
    """Bring counts, snapshot and deltas below `root` up to date with one batch of changes.

    The form without a stream: the counts of every live name are a table that each batch
    writes anew, which suits few and large batches; `live_top_k` keeps them in state. A name
    comes into the snapshot whenever it is among the K largest, also when it is others that
    fall. Among equal counts the first names by order are held. Each version is made from the
    one of an earlier batch, so a batch that is run again gives the same result; how changes
    are cut into batches does not matter.
    """
    spark = changes.sparkSession
    last = storage.newest_version(spark, _snapshots(root), before=batch_id)
    counts = next_counts(_version(spark, _counts(root), last, COUNTS), changes)
    counts.write.mode("overwrite").parquet(storage.version_path(_counts(root), batch_id))
    counts = _version(spark, _counts(root), batch_id, COUNTS)
    _publish(spark, changelog.top_k(counts.select("name", "count"), k), last, batch_id, root)
    for kind in (_counts(root), _snapshots(root)):
        storage.drop_versions(spark, kind, keep_seconds)


def shard_tops(changes: DataFrame, k: int = changelog.LIVE_ENTRIES, mode: str = "update") -> DataFrame:
    """(shard, name, count): the K largest of each shard in which they changed."""
    shard = F.pmod(F.xxhash64("name"), F.lit(SHARDS)).cast("int").alias("shard")
    dealt = changes.where("name IS NOT NULL").select(shard, "name", "count", "seq")
    return (
        dealt.mapInArrow(state.newest_in_batch, CHANGES)
        .groupBy("shard")
        .transformWithState(state.ShardTop(k), TOPS, mode, "None")
    )


def merge_tops(
    tops: DataFrame,
    batch_id: int,
    root: str,
    k: int = changelog.LIVE_ENTRIES,
    keep_seconds: float = KEEP_SECONDS,
) -> None:
    """Bring snapshot and deltas below `root` up to date with the shards that changed.

    `tops` is computed once. A batch that is run again starts from the same earlier version.
    """
    spark = tops.sparkSession
    last = storage.newest_version(spark, _snapshots(root), before=batch_id)
    path = storage.version_path(_changed(root), batch_id)
    tops.repartition(1).write.mode("overwrite").parquet(path)
    changed = _version(spark, _changed(root), batch_id, TOPS)
    others = _version(spark, _tops(root), last, TOPS).join(changed.select("shard"), "shard", "left_anti")
    path = storage.version_path(_tops(root), batch_id)
    others.unionByName(changed).coalesce(1).write.mode("overwrite").parquet(path)
    entries = _version(spark, _tops(root), batch_id, TOPS).where("name IS NOT NULL")
    _publish(spark, changelog.top_k(entries.select("name", "count"), k), last, batch_id, root)
    for kind in (_changed(root), _tops(root), _snapshots(root)):
        storage.drop_versions(spark, kind, keep_seconds)


def live_top_k(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    k: int = changelog.LIVE_ENTRIES,
    mode: str = "update",
    keep_seconds: float = KEEP_SECONDS,
) -> DataStreamWriter:
    """Keep snapshots and deltas below `root` for a stream of count changes.

    All live names are ranked, so a name comes back when others fall; ties go by name. Use a
    trigger of one second for one flush per second.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_tops(batch, batch_id, root, k, keep_seconds)

    return (
        shard_tops(changes, k, mode).writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def read_snapshot(
    spark: SparkSession, root: str, batch_id: int | None = None
) -> tuple[int, DataFrame]:
    """(batch id, snapshot), the newest one or an earlier one; batch id -1 before the first."""
    if batch_id is None:
        batch_id = storage.newest_version(spark, _snapshots(root))
    return -1 if batch_id is None else batch_id, _version(spark, _snapshots(root), batch_id, SNAPSHOT)


def read_deltas(spark: SparkSession, root: str, after: int = -1) -> DataFrame:
    """(batch_id, name, count): the deltas of the batches after `after`.

    Only the folders from that batch on are read. A batch that was run again after a failure
    may have written the same rows twice; they count once.
    """
    if not storage.exists(spark, _deltas(root)):
        return spark.createDataFrame([], "batch_id long, name string, count long")
    found = spark.read.schema(DELTAS).parquet(_deltas(root))
    later = (F.col("block") >= max(after, 0) // BLOCK_BATCHES) & (F.col("batch_id") > after)
    return found.where(later).select("batch_id", "name", "count").distinct()


def read_messages(spark: SparkSession, root: str, after: int = -1) -> DataFrame:
    """(batch_id, message): one JSON array per batch that changed the snapshot."""
    return changelog.update_messages(read_deltas(spark, root, after), "batch_id")


def snapshot_message(snapshot: DataFrame) -> DataFrame:
    """(message): the snapshot as one JSON array; no row when it is empty."""
    return changelog.update_messages(snapshot).where(F.col("message") != "[]")

"""What a stream's batches held: rows, rows that came too late, and what Spark says of its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from ..functions import times
from . import storage

REPORT = "batch_id long, rows long, late long, newest long"


def reports(mentions: DataFrame, root: str, checkpoint: str, delay: int) -> DataStreamWriter:
    """Publish one row for each batch of a stream of (..., timestamp) below `root`.

    `late` counts the rows that a watermark of `delay` seconds drops: those of a second no later
    than the newest second of earlier batches minus the delay. `newest` is the newest second of
    the batch, null if it has none. Rows without a timestamp are never late. Earlier reports
    tell the newest second so far, so a batch that runs again, also after a restart, gives the
    same row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        publish_report(batch, root, batch_id, delay)

    return mentions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def publish_report(batch: DataFrame, root: str, batch_id: int, delay: int) -> None:
    """The report of one batch; see `reports`."""
    spark = batch.sparkSession
    second, late = times.whole_seconds("timestamp"), F.lit(0)
    newest = newest_second(spark, root, batch_id)
    if newest is not None:
        late = (F.col("timestamp").isNotNull() & (second <= newest - delay)).cast("int")
    counted = batch.agg(
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(late), F.lit(0)).cast("long").alias("late"),
        F.max(second).alias("newest"),
    )
    storage.publish(counted, root, batch_id)


def newest_second(spark: SparkSession, root: str, before: int) -> int | None:
    """The newest second that the reports before a batch tell; one row each."""
    found = read_reports(spark, root).where(F.col("batch_id") < before)
    return found.agg(F.max("newest").alias("newest")).first()["newest"]


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, rows, late, newest) of the batches that are complete."""
    return storage.read_versions(spark, root, REPORT)


def observed(df: DataFrame, name: str, second: str = "timestamp") -> tuple[DataFrame, Observation]:
    """A batch of a stream with its rows, oldest and newest second counted on the way through."""
    seen = Observation(name)
    of = times.whole_seconds(second)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.min(of).alias("oldest"), F.max(of).alias("newest")), seen


class Progress(StreamingQueryListener):
    """Keeps one row for each batch of the queries of a session, the newest `keep` of them.

    Rows are (name, batch_id, rows, late, state_rows, expired_rows, watermark). Late rows are
    those that Spark's operators dropped: where mentions are added up before, these are sums, and
    `reports` counts mentions. Add it with `spark.streams.addListener`.
    """

    def __init__(self, keep: int = 3_600):
        self.keep = keep
        self.batches: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        state = progress.stateOperators
        self.batches.append(
            {
                "name": progress.name,
                "batch_id": progress.batchId,
                "rows": progress.numInputRows,
                "late": sum(o.numRowsDroppedByWatermark for o in state),
                "state_rows": sum(o.numRowsTotal for o in state),
                "expired_rows": sum(o.numRowsRemoved for o in state),
                "watermark": progress.eventTime.get("watermark"),
            }
        )
        del self.batches[: -self.keep]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

"""Session settings the queries rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top rows of a group are cut in every task before the shuffle, whatever their number.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
}

STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# One shuffle partition should hold about this much; AQE joins smaller ones.
PARTITION_BYTES = 256 << 20

# A daily count shuffles about a tenth of the bytes of the records it reads.
SHUFFLED_SHARE = 0.1

# A live query runs every second or minute and keeps its number of partitions for ever.
STREAM_PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(spark: SparkSession, input_bytes: int) -> int:
    """How many partitions a batch query over so many bytes begins its shuffles with."""
    wanted = -(-int(input_bytes * SHUFFLED_SHARE) // PARTITION_BYTES)
    return max(int(spark.conf.get(STREAM_PARTITIONS)), wanted)


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path, on any file system; 0 where there are none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def configure(
    spark: SparkSession, streaming: bool = False, input_bytes: int | None = None
) -> SparkSession:
    """Apply the settings that can be changed on a running session.

    With `input_bytes`, batch shuffles begin with a number of partitions for that input:
    100 TB begin with about 40,000, and AQE joins what turns out small. It does not touch
    `spark.sql.shuffle.partitions`, which streaming queries go by: AQE never splits or joins
    theirs, so that number is to be set for one micro-batch.
    """
    settings = SETTINGS | STREAM_SETTINGS if streaming else dict(SETTINGS)
    if input_bytes is not None:
        settings[INITIAL_PARTITIONS] = str(shuffle_partitions(spark, input_bytes))
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark

"""Folders of streaming queries, on whatever file system their paths name."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_PREFIX = "b"


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and tables between queries.

    It is `spark.checkpoint.dir`, else the context's checkpoint folder. Only a session
    that runs on one machine may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return temporary_dir()


@cache
def temporary_dir() -> str:
    """One folder for the process, removed when it ends."""
    path = tempfile.mkdtemp(prefix="namepulse-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run: a query started in it begins without state."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, hadoop


def version_path(root: str, batch_id: int) -> str:
    return f"{root}/{_PREFIX}{batch_id:012d}"


def _listed(spark: SparkSession, root: str) -> list[tuple[int, object]]:
    """(batch id, status) of the version folders below root, newest first; one listing."""
    fs, path, _ = _fs(spark, root)
    if not fs.exists(path):
        return []
    found = [(s.getPath().getName(), s) for s in fs.listStatus(path)]
    ids = [(int(n.removeprefix(_PREFIX)), s) for n, s in found if n.startswith(_PREFIX)]
    return sorted(ids, key=lambda x: -x[0])


def exists(spark: SparkSession, path: str) -> bool:
    fs, at, _ = _fs(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, if it is there."""
    fs, at, _ = _fs(spark, path)
    fs.delete(at, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to its end."""
    fs, at, hadoop = _fs(spark, path)
    return fs.exists(hadoop.Path(at, "_SUCCESS"))


def versions(spark: SparkSession, root: str, after: int = -1) -> list[int]:
    """Batch ids above `after` of the complete versions below `root`, ascending."""
    ids = [i for i, _ in _listed(spark, root) if i > after]
    return sorted(i for i in ids if is_complete(spark, version_path(root, i)))


def newest_version(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """The newest complete version, of those before a batch; looks at no more than it must."""
    for batch_id, _ in _listed(spark, root):
        earlier = before is None or batch_id < before
        if earlier and is_complete(spark, version_path(root, batch_id)):
            return batch_id
    return None


def publish(df: DataFrame, root: str, batch_id: int) -> None:
    """Write one batch once, straight to its folder; the marker written last makes it count.

    A batch that is run again leaves a complete folder as it is and overwrites another. It
    needs no rename, which object stores do not have.
    """
    target = version_path(root, batch_id)
    if not is_complete(df.sparkSession, target):
        df.write.mode("overwrite").parquet(target)


def publish_slices(
    df: DataFrame, root: str, slice_of: Column, slices: int, after: Callable[[], None]
) -> None:
    """Publish a table slice by slice: `slice_of` says which, from 0; `after` is called after each.

    A stream of the versions gets a slice as a whole. df is computed once; a slice is as many
    files as its rows came in.
    """
    staged = f"{root.rstrip('/')}-staged"
    df.withColumn("_slice", slice_of).write.partitionBy("_slice").parquet(staged)
    schema = T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType())])
    numbered = df.sparkSession.read.schema(schema).parquet(staged)
    for k in range(slices):
        publish(numbered.where(F.col("_slice") == k).drop("_slice"), root, k)
        after()


def unmark(spark: SparkSession, root: str, batch_id: int) -> None:
    """Take a version's marker away: it does not count until it is published again."""
    fs, at, hadoop = _fs(spark, version_path(root, batch_id))
    fs.delete(hadoop.Path(at, "_SUCCESS"), False)


def read_versions(spark: SparkSession, root: str, schema, after: int = -1) -> DataFrame:
    """The rows of the complete versions after a batch."""
    paths = [version_path(root, i) for i in versions(spark, root, after)]
    reader = spark.read.schema(schema)
    return reader.parquet(*paths) if paths else spark.createDataFrame([], schema)


def drop_versions(spark: SparkSession, root: str, keep_seconds: float) -> None:
    """Delete versions written more than `keep_seconds` before the newest.

    The two newest always stay: the last batch may be run again, from the one before.
    """
    found = _listed(spark, root)
    if not found:
        return
    newest = found[0][1].getModificationTime()
    for batch_id, status in found[2:]:
        if newest - status.getModificationTime() > keep_seconds * 1000:
            fs, path, _ = _fs(spark, version_path(root, batch_id))
            fs.delete(path, True)

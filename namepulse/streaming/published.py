"""A streaming source of published versions: what has its marker, each version once.

`storage.publish` writes a batch to a folder of its own and marks it last. A file stream over
those folders would read a folder before its marker is there, and read the files of a second
attempt again. Here an offset is the number of the newest version up to which all are marked,
so that a version is read when it is complete, in order, and never again, whatever happens to
its files afterwards. A version without its marker holds back those after it until it has run
again.

Read with a pace, a backlog does not come at once: each trigger takes what is waiting divided by
the seconds that are left of the interval, so that the backlog is gone when the next one is due.

This module imports nothing from the package and is pickled by value, so that executors need
no copy of the package. It reaches any file system that Arrow knows by a URI.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# How `storage` names versions and Spark marks folders.
PREFIX = "b"
MARKER = "_SUCCESS"

FORMAT = "published"


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or a local path, and the path on it."""
    found = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    return found[0], found[1].rstrip("/")


def _number(name: str) -> int | None:
    digits = name.removeprefix(PREFIX)
    return int(digits) if name != digits and digits.isascii() and digits.isdigit() else None


def _folders(system: fs.FileSystem, root: str) -> dict[int, str]:
    selector = fs.FileSelector(root, allow_not_found=True)
    found = {_number(i.base_name): i.path for i in system.get_file_info(selector) if i.type == fs.FileType.Directory}
    found.pop(None, None)
    return found


class PublishedReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: T.StructType, newest_only: bool):
        self.path, self.columns, self.newest_only = path, schema, newest_only
        self.seen: int | None = None  # versions up to here were looked at and are marked

    def _newest(self) -> int:
        """The last of the versions that are all marked; looks at each one once."""
        system, root = _file_system(self.path)
        folders = _folders(system, root)
        at = -1 if self.seen is None else self.seen
        for number in sorted(n for n in folders if n > at):
            if system.get_file_info(f"{folders[number]}/{MARKER}").type == fs.FileType.NotFound:
                break
            at = number
        self.seen = at
        return at

    def initialOffset(self) -> dict:
        return {"version": self._newest() if self.newest_only else -1}

    def latestOffset(self) -> dict:
        return {"version": self._newest()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """One for every file of the versions after `start` up to `end`."""
        system, root = _file_system(self.path)
        folders = _folders(system, root)
        found = []
        for number in sorted(n for n in folders if start["version"] < n <= end["version"]):
            files = system.get_file_info(fs.FileSelector(folders[number], recursive=True))
            found += sorted(i.path for i in files if i.type == fs.FileType.File and i.size and i.base_name[0] not in "._")
        return [InputPartition(path) for path in found]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = _file_system(self.path)
        wanted = to_arrow_schema(self.columns)
        with system.open_input_file(partition.value) as file:
            for batch in pq.ParquetFile(file).iter_batches(columns=wanted.names):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name).cast(f.type, safe=False) for f in wanted], schema=wanted
                )


class PacedReader(PublishedReader):
    """Takes versions at a pace that empties the backlog at the end of each interval.

    The version given last is kept in the file `pace`, written before it is given: a reader that
    starts again goes on from there and never gives an older one. Should the query have ended
    between the two, its next batch also has the versions of the one that was lost.
    """

    def __init__(self, path: str, schema: T.StructType, newest_only: bool, pace: str, interval: int, clock: int | None):
        super().__init__(path, schema, newest_only)
        self.pace, self.interval, self.clock = pace, interval, clock

    def _given(self) -> dict:
        """The version given last, how many triggers there were, and the version to begin after."""
        system, path = _file_system(self.pace)
        if system.get_file_info(path).type == fs.FileType.NotFound:
            first = super().initialOffset()["version"]
            return self._give(first, 0, first)
        with system.open_input_stream(path) as file:
            return json.loads(file.read())

    def _give(self, version: int, trigger: int, first: int) -> dict:
        system, path = _file_system(self.pace)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        given = {"version": version, "trigger": trigger, "first": first}
        with system.open_output_stream(f"{path}.next") as file:
            file.write(json.dumps(given).encode())
        system.move(f"{path}.next", path)
        return given

    def _seconds_left(self, trigger: int) -> int:
        now = int(time.time()) if self.clock is None else self.clock + trigger
        return self.interval - now % self.interval

    def initialOffset(self) -> dict:
        # Spark asks for it after the latest one of the first trigger.
        return {"version": self._given()["first"]}

    def latestOffset(self) -> dict:
        given, newest = self._given(), self._newest()
        system, root = _file_system(self.path)
        waiting = sorted(n for n in _folders(system, root) if given["version"] < n <= newest)
        if waiting:
            taken = -(-len(waiting) // self._seconds_left(given["trigger"]))
            given = self._give(waiting[taken - 1], given["trigger"] + 1, given["first"])
        return {"version": given["version"]}


class Published(DataSource):
    """Options: path; startingVersions, `earliest` (the default) or `latest`.

    With `pace`, the path of a file of the query's own: interval, in seconds; clock, the second
    of the first trigger, each later one being a second on, in place of the system's clock.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> PublishedReader:
        latest = self.options.get("startingversions", "earliest").lower() == "latest"
        given = self.options["path"], schema, latest
        if "pace" not in self.options:
            return PublishedReader(*given)
        clock = self.options.get("clock")
        return PacedReader(*given, self.options["pace"], int(self.options["interval"]), int(clock) if clock else None)


def stream(spark: SparkSession, root: str, schema: T.StructType, starting: str = "earliest", **options) -> DataFrame:
    """The rows of the versions below `root` as a stream; `latest` leaves out those marked by now."""
    spark.dataSource.register(Published)
    reader = spark.readStream.format(FORMAT).schema(schema).option("startingVersions", starting)
    return reader.options(**options).load(root)


def paced_stream(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    pace: str,
    interval: int = 900,
    clock: int | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """The same stream, a backlog spread over the triggers of a second left of the interval.

    `pace` is a file that belongs to the query as its checkpoint does. `availableNow` takes one
    trigger's share; use a trigger of a second.
    """
    options = {"pace": pace, "interval": interval} | ({} if clock is None else {"clock": clock})
    return stream(spark, root, schema, starting, **options)

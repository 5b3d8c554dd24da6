"""Segment files of a window of time, planned from their names.

The names of segment files tell their time. Where both ends of a window are given, the names in
it are looked up one by one and nothing is listed; where one is open, the folder is listed once
and names outside are left out. Either way Spark gets the paths wanted and opens no others.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import drop_malformed_utf8
from ..functions.times import parse_record_time

SCHEMA = "value string, file_name string, segment timestamp"

# How a segment is named, and its minutes.
STAMP = "%Y%m%d%H%M00"
NAME = "{}.gkg.csv"
MINUTES = 15

# Names looked up one by one at most; a longer window is listed.
LOOKED_UP = 10_000
UTC = timezone.utc
ZERO = datetime(1970, 1, 1, tzinfo=UTC)


@dataclass
class Plan:
    """Paths of the segments, each a file or a folder of files, and how many folders were listed."""

    paths: list[str]
    listed: int


def _utc(at: datetime | None) -> datetime | None:
    """Times without a zone are UTC."""
    return at and (at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC))


def _begins(at: datetime, minutes: int) -> bool:
    """Whether a segment begins at a time."""
    return not (at - ZERO) % timedelta(minutes=minutes)


def _candidates(since: datetime | None, until: datetime | None, minutes: int) -> list[datetime] | None:
    """The segments of the window, or None if it is open or holds too many to look up."""
    if since is None or until is None:
        return None
    step = timedelta(minutes=minutes)
    first = ZERO - ((ZERO - since) // step) * step
    n = max(0, -((first - until) // step))
    return [first + i * step for i in range(n)] if n <= LOOKED_UP else None


def _time_of(file_name: str, name: str, minutes: int) -> datetime | None:
    before, _, after = name.partition("{}")
    if not (file_name.startswith(before) and file_name.endswith(after)):
        return None
    stamp = file_name[len(before) : len(file_name) - len(after)]
    try:
        at = datetime.strptime(stamp, STAMP).replace(tzinfo=UTC)
    except ValueError:
        return None
    return at if at.strftime(STAMP) == stamp and _begins(at, minutes) else None


def plan(
    path: str, since: datetime | None = None, until: datetime | None = None, name: str = NAME, minutes: int = MINUTES
) -> Plan:
    """The segments below a path that begin from `since` on and before `until`; None is open."""
    since, until, path = _utc(since), _utc(until), path.rstrip("/")
    system, root = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    candidates = _candidates(since, until, minutes)
    if candidates is not None:
        names = [name.replace("{}", at.strftime(STAMP)) for at in candidates]
        infos = system.get_file_info([f"{root}/{n}" for n in names]) if names else []
        return Plan([f"{path}/{n}" for n, i in zip(names, infos) if i.type != fs.FileType.NotFound], 0)
    found = [(_time_of(i.base_name, name, minutes), i.base_name) for i in system.get_file_info(fs.FileSelector(root))]
    wanted = [
        n for at, n in found if at is not None and (since is None or at >= since) and (until is None or at < until)
    ]
    return Plan([f"{path}/{n}" for n in sorted(wanted)], 1)


def read_timed(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    until: datetime | None = None,
    name: str = NAME,
    minutes: int = MINUTES,
) -> DataFrame:
    """(value, file_name, segment) of the segments that begin from `since` on and before `until`.

    Times without a zone are UTC. Files whose names tell no time at which a segment begins are
    left out. Bytes that are no UTF-8 are left out of their lines.
    """
    paths = plan(path, since, until, name, minutes).paths
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    before, _, after = name.partition("{}")
    pattern = f"/{re.escape(before)}([0-9]{{14}}){re.escape(after)}(/|$)"
    stamp = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return spark.read.text(paths).select(
        drop_malformed_utf8("value").alias("value"),
        F.concat(F.lit(before), stamp, F.lit(after)).alias("file_name"),
        parse_record_time(stamp).alias("segment"),
    )

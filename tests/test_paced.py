"""Streams that spread a backlog over the time that is left."""

import json
from pathlib import Path

import pytest

from namepulse import schemas
from namepulse.streaming import lifecycle, published, storage
from test_published import lines


def reader(folder, clock=0, interval=5, newest_only=False):
    return published.PacedReader(f"{folder}/log", schemas.RECORD_STREAM, newest_only, f"{folder}/pace", interval, clock)


def fill(spark, folder, batch_ids):
    for i in batch_ids:
        storage.publish(lines(spark, [f"k{i}"]), f"{folder}/log", i)


def offsets(source, n):
    return [source.latestOffset()["version"] for _ in range(n)]


def test_a_backlog_is_gone_at_the_end_of_the_interval(spark):
    folder = storage.fresh_dir(spark, "paced")
    fill(spark, folder, range(7))
    source = reader(folder)
    assert offsets(source, 6) == [1, 3, 4, 5, 6, 6]
    assert source.initialOffset() == {"version": -1}
    fill(spark, folder, (7, 8))  # the next interval has its own five seconds
    assert offsets(source, 3) == [7, 8, 8]


@pytest.mark.parametrize("clock, first", [(0, 0), (4, 3), (3, 1)])
def test_the_later_the_faster(spark, clock, first):
    folder = storage.fresh_dir(spark, "paced")
    fill(spark, folder, range(4))
    assert reader(folder, clock).latestOffset() == {"version": first}


def test_a_reader_that_starts_again_goes_on(spark):
    folder = storage.fresh_dir(spark, "paced")
    fill(spark, folder, range(7))
    assert offsets(reader(folder), 2) == [1, 3]
    assert offsets(reader(folder), 2) == [4, 5]
    assert reader(folder).initialOffset() == {"version": -1}


def test_versions_without_a_marker_are_no_backlog(spark):
    folder = storage.fresh_dir(spark, "paced")
    assert reader(folder).latestOffset() == {"version": -1}
    fill(spark, folder, range(4))
    storage.unmark(spark, f"{folder}/log", 1)
    source = reader(folder, clock=4)
    assert offsets(source, 2) == [0, 0]
    fill(spark, folder, [1])
    assert json.loads(Path(f"{folder}/pace").read_text())["trigger"] == 1
    assert offsets(source, 2) == [1, 2]


def test_the_newest_only(spark):
    folder = storage.fresh_dir(spark, "paced")
    fill(spark, folder, range(3))
    source = reader(folder, clock=4, newest_only=True)
    assert offsets(source, 1) == [2] and source.initialOffset() == {"version": 2}
    fill(spark, folder, [3])
    assert offsets(source, 1) == [3]


def test_each_row_once_over_restarts(spark):
    folder = storage.fresh_dir(spark, "paced")
    fill(spark, folder, range(5))
    source = published.paced_stream(
        spark, f"{folder}/log", schemas.RECORD_STREAM, f"{folder}/pace", interval=3, clock=0
    )
    for _ in range(2):
        query = lifecycle.file_writer(source, f"{folder}/out", f"{folder}/state").start()
        query.processAllAvailable()
        assert lifecycle.stop(query)
        fill(spark, folder, [5])
    found = spark.read.schema(schemas.RECORD_STREAM).parquet(f"{folder}/out")
    assert sorted(r.key for r in found.collect()) == [f"k{i}" for i in range(6)]

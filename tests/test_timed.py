"""Segment files planned from the window wanted."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from namepulse.sources import timed
from test_segments import START, write_segment

AT = START.replace(tzinfo=timezone.utc)


EMPTY = "20150219010000.gkg.csv"


def minutes(n):
    return AT + timedelta(minutes=n)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("timed")
    for i in range(8):
        write_segment(path, START + timedelta(minutes=15 * i), i + 1)
    (path / "20150218230700.gkg.csv").write_text("no segment begins then\n")
    (path / "masterfilelist.txt").write_text("no segment\n")
    (path / EMPTY).write_text("")
    return str(path)


def planned(folder, since=None, until=None):
    """How many files are planned and how many folders listed."""
    found = timed.plan(folder, since, until)
    return len(found.paths), found.listed


def test_a_window_is_looked_up_without_a_listing(folder):
    assert planned(folder, minutes(15), minutes(60)) == (3, 0)
    assert planned(folder, minutes(16), minutes(61)) == (3, 0)
    assert planned(folder, minutes(30), minutes(31)) == (1, 0)
    assert planned(folder, minutes(61), minutes(74)) == (0, 0)
    assert planned(folder, minutes(61), minutes(2)) == (0, 0)
    assert planned(folder, minutes(15), minutes(15)) == (0, 0)
    assert planned(folder, minutes(-100), minutes(400)) == (9, 0)


def test_open_ends_list_once(folder):
    assert planned(folder) == (9, 1)
    assert planned(folder, since=minutes(75)) == (4, 1)
    assert planned(folder, until=minutes(16)) == (2, 1)
    assert planned(folder, minutes(-10_000_000), minutes(20)) == (2, 1)


WINDOWS = [(None, None), (15, 75), (None, 20), (61, None), (14, 16), (31, 44), (75, 15), (0, 0.5)]


@pytest.mark.parametrize("since, until", WINDOWS)
def test_rows_equal_the_filtered_scan(spark, folder, since, until):
    ends = [None if m is None else START + timedelta(minutes=m) for m in (since, until)]
    want = [
        r
        for r in timed.read_timed(spark, folder).collect()
        if (ends[0] is None or r.segment >= ends[0]) and (ends[1] is None or r.segment < ends[1])
    ]
    got = timed.read_timed(spark, folder, *ends)
    assert sorted(got.collect()) == sorted(want)
    assert {f.rsplit('/')[-1] for f in got.inputFiles()} - {EMPTY} == {r.file_name for r in want}


def test_a_table_may_be_used_with_different_filters(spark, folder):
    """Also where the session lets sources take filters."""
    lines = timed.read_timed(spark, folder)
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    try:
        for on in ("true", "false"):
            spark.conf.set(key, on)
            one, two = (lines.where(f"segment = '2015-02-18 23:{m}:00'") for m in (15, 30))
            assert (one.count(), two.count(), one.union(two).count(), lines.count()) == (2, 3, 5, 36)
            assert one.union(lines).count() == 38
    finally:
        spark.conf.set(key, before)


def test_zones(spark, folder):
    since = AT.astimezone(timezone(timedelta(hours=5))) + timedelta(minutes=90)
    assert timed.read_timed(spark, folder, since).count() == 7 + 8


def test_lines_are_whole(spark, tmp_path):
    given = ["short", "", "x" * 100, "é" * 40, "end"]
    data = "\n".join(given[:-1]).encode() + b"\r\n\xff" + given[-1].encode()
    (tmp_path / "20150218230000.gkg.csv").write_bytes(data)
    got = timed.read_timed(spark, str(tmp_path))
    assert sorted(r.value for r in got.collect()) == sorted(given)
    assert {(r.file_name, r.segment) for r in got.collect()} == {
        ("20150218230000.gkg.csv", datetime(2015, 2, 18, 23, 0))
    }


def test_folders_and_other_names(spark, tmp_path):
    rows = spark.range(40).select(
        F.col("id").cast("string").alias("value"), F.format_string("201502%02d000000", F.col("id") % 4 + 1).alias("day")
    )
    rows.write.partitionBy("day").text(str(tmp_path / "days"))
    day = datetime(2015, 2, 2)
    options = {"name": "day={}", "minutes": 24 * 60}
    assert timed.read_timed(spark, str(tmp_path / "days"), **options).count() == 40
    got = timed.read_timed(spark, str(tmp_path / "days"), day, day + timedelta(days=1), **options)
    assert {r.segment for r in got.collect()} == {day} and got.count() == 10


def test_an_empty_folder(spark, tmp_path):
    assert timed.read_timed(spark, str(tmp_path)).count() == 0

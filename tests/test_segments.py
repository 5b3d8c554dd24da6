from datetime import datetime, timedelta

import golden
import pytest
from pyspark.sql import functions as F

from namepulse.operators import log
from namepulse.sources import records, segments


def write_segment(folder, start, n, extra=0):
    """A segment file of `n` lines; returns its lines."""
    stamp = start.strftime("%Y%m%d%H%M%S")
    lines = [
        golden.record_line(f"{stamp}-{i}", stamp, f"Name{i % 3},{i}", "x" * extra)
        for i in range(n)
    ]
    (folder / f"{stamp}.gkg.csv").write_text("".join(line + "\n" for line in lines))
    return lines


START = datetime(2015, 2, 18, 23, 0)


def test_index(spark, tmp_path):
    base = "http://files.example/v2/gkg/2015021823"
    (tmp_path / "index.txt").write_text(
        "".join(f"{base}{m}00.gkg.csv\n" for m in ("00", "15", "30"))
    )
    got = segments.read_segment_index(spark, str(tmp_path / "index.txt"), 2, "s3a://bucket")
    assert [tuple(r) for r in got.collect()] == [
        ("s3a://bucket/v2/gkg/20150218230000.gkg.csv", "20150218230000.gkg.csv"),
        ("s3a://bucket/v2/gkg/20150218231500.gkg.csv", "20150218231500.gkg.csv"),
    ]


def test_lines_of_many_files_and_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"a\xffb\nc\n")
    (tmp_path / "b.txt").write_bytes(b"c\n")
    (tmp_path / "empty.txt").write_bytes(b"")
    got = records.read_lines(spark, [str(tmp_path / f"{n}.txt") for n in ("a", "b", "empty")])
    assert sorted(r.value for r in got.collect()) == ["ab", "c", "c"]


def test_only_newer_files(spark, tmp_path):
    for i in range(3):
        write_segment(tmp_path, START + timedelta(minutes=15 * i), 2)
    got = segments.read_new_segments(spark, str(tmp_path), "20150218231500.gkg.csv")
    assert {r.file_name for r in got.collect()} == {"20150218233000.gkg.csv"}


@pytest.mark.parametrize("n", [4, 7])
def test_spread(spark, tmp_path, n):
    lines = write_segment(tmp_path, START, n)
    got = segments.keyed_lines(segments_of(spark, tmp_path)).orderBy("offset").collect()
    assert [r.value for r in got] == lines
    assert got[0].key == "20150218230000-0"
    assert [(r.timestamp - START) / timedelta(milliseconds=1) for r in got] == [
        i * 900_000 // n for i in range(n)
    ]


def segments_of(spark, folder):
    return records.read_positioned_lines(spark, str(folder))


def test_lines_keep_their_place_over_many_splits(spark, tmp_path):
    """One file in many input splits, next to a small one."""
    big = write_segment(tmp_path, START, 3000, extra=200)
    small = write_segment(tmp_path, START + timedelta(minutes=15), 5)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        lines = segments_of(spark, tmp_path)
        assert lines.select("file_path", "file_block").distinct().count() > 10
        keyed = segments.keyed_lines(lines).orderBy("offset").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r.value for r in keyed] == big + small
    assert len({r.offset for r in keyed}) == 3005
    times = [r.timestamp for r in keyed]
    assert times == sorted(times) and times[3000] == START + timedelta(minutes=15)
    assert times[2999] == START + timedelta(milliseconds=300 * 2999)


def test_last_key(spark):
    rows = [("b", 2), ("c", 3), ("a", 1)]
    assert log.last_key(spark.createDataFrame(rows, "key string, offset long")).first()[0] == "c"
    empty = spark.createDataFrame([], "key string, offset long")
    assert log.last_key(empty).first()[0] == "20150218230000-0"


def test_window_listing(spark):
    df = spark.createDataFrame([(datetime(2015, 2, 18, 23, 37, 12),)], "now timestamp")
    got = [r.file_name for r in segments.segments_in_window(df, F.col("now")).collect()]
    assert got[0] == "20150218223000.gkg.csv" and got[-1] == "20150218231500.gkg.csv"

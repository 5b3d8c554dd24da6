"""Days refreshed segment by segment, and counts per segment of event time."""

import os

import golden  # noqa: F401  (puts the golden cases' folder on the path)
from pyspark.sql import functions as F

from namepulse.operators import daily
from namepulse.plans import refresh
from namepulse.streaming import cadence, lifecycle, published, storage
from test_rolling import EPOCH, mentions

SCHEMA = "day string, name string"


def of(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def whole(spark, root):
    return sorted(map(tuple, refresh.read_top(spark, root).collect()))


def day_files(root):
    local = f"{root}/top".removeprefix("file:")
    return {d: {(f, os.stat(f"{local}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{local}/{d}")} for d in os.listdir(local) if "=" in d}


def test_a_late_segment_rewrites_its_day_only(spark):
    root = storage.fresh_dir(spark, "refresh")
    rows = [("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "a"), ("2024-01-02", "c"), ("2024-01-03", "d")]
    assert refresh.add_segment(of(spark, *rows), "s1", root) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    before = day_files(root)
    late = [("2024-01-02", "c"), ("2024-01-02", "c")]
    assert refresh.add_segment(of(spark, *late), "s0", root) == {"2024-01-02"}
    after = day_files(root)
    assert {d for d in before if before[d] != after[d]} == {"day=2024-01-02"}
    want = daily.top_names(daily.daily_counts(of(spark, *rows, *late)))
    assert whole(spark, root) == sorted(map(tuple, want.collect()))


def test_segments_may_come_again_or_change(spark):
    root = storage.fresh_dir(spark, "refresh")
    first = of(spark, ("d1", "a"), ("d1", "a"), ("d2", "b"))
    refresh.add_segment(first, "s", root)
    refresh.add_segment(first, "s", root)
    assert whole(spark, root) == [("d1", 1, "a", 2), ("d2", 1, "b", 1)]
    assert refresh.add_segment(of(spark, ("d1", "c")), "s", root) == {"d1", "d2"}
    assert whole(spark, root) == [("d1", 1, "c", 1)]  # d2 has no counts any more
    assert refresh.add_segment(of(spark).limit(0), "s", root) == {"d1"}
    assert whole(spark, root) == []
    assert refresh.add_segment(of(spark).limit(0), "t", root) == set()


def test_a_refresh_reads_the_days_it_ranks(spark):
    root = storage.fresh_dir(spark, "refresh")
    refresh.add_segment(of(spark, *[(f"d{i}", "a") for i in range(9)]), "s", root)
    found = refresh.read_counts(spark, root).where(F.col("day").isin("d3"))
    assert len(found.inputFiles()) >= 1 and found.count() == 1
    assert "PartitionFilters: [isnotnull(day" in found._jdf.queryExecution().executedPlan().toString()


def test_segments_are_counted_once_and_too_late_mentions_dropped(spark):
    folder = storage.fresh_dir(spark, "cadence")
    batches = [
        [("a", 90_000), ("a", 90_899), ("b", 90_900)],
        [("a", 94_600), ("a", 90_100)],  # late, but its segment is still open
        [("z", 98_200), ("a", 90_200)],  # too late: closed with the batch before
        [("z", 99_900)],
    ]
    source = published.stream(spark, f"{folder}/in", mentions(spark, []).schema)
    counts = cadence.segment_counts(source, 3_600)
    query = None
    for k, rows in enumerate(batches):
        storage.publish(mentions(spark, rows), f"{folder}/in", k)
        query = query or lifecycle.file_writer(counts, f"{folder}/out", f"{folder}/state").start()
        query.processAllAvailable()
    assert lifecycle.stop(query)
    found = spark.read.schema("segment string, name string, count long").parquet(f"{folder}/out").collect()

    def segment(sec):
        return (EPOCH + (mentions_time(sec) - mentions_time(0))).strftime("%Y%m%d%H%M%S")

    def mentions_time(sec):
        return mentions(spark, [("x", sec)]).first()["timestamp"]

    assert sorted(map(tuple, found)) == [
        (segment(90_000), "a", 3), (segment(90_900), "b", 1), (segment(94_500), "a", 1)
    ]

"""Reports of what the batches of a stream held."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from namepulse.streaming import cadence, lifecycle, progress, published, storage

T0 = datetime(2024, 1, 1)
SCHEMA = "name string, timestamp timestamp"
BATCHES = [
    [("a", 0), ("a", 1_000), ("b", 900)],
    [("a", 100), ("a", 400), ("b", 401), ("b", 1_200), ("a", None)],  # watermark 1000 - 600
    [],
    [("c", 600), ("c", 600), ("c", 601), ("c", 5)],  # watermark 1200 - 600
]


def rows(spark, batch):
    found = [(n, None if s is None else T0 + timedelta(seconds=s)) for n, s in batch]
    return spark.createDataFrame(found, SCHEMA)


def second(s):
    return 1704067200 + s


WANT = [
    (0, 3, 0, second(1_000)),
    (1, 5, 2, second(1_200)),
    (2, 0, 0, None),
    (3, 4, 3, second(601)),
]


def test_late_rows_of_each_batch(spark):
    root = storage.fresh_dir(spark, "reports")
    for i, batch in enumerate(BATCHES):
        progress.publish_report(rows(spark, batch), root, i, 600)
    assert sorted(map(tuple, progress.read_reports(spark, root).collect())) == WANT


def test_a_batch_that_runs_again_gives_the_same_report(spark):
    root = storage.fresh_dir(spark, "reports")
    for i, batch in enumerate(BATCHES):
        progress.publish_report(rows(spark, batch), root, i, 600)
    storage.unmark(spark, root, 1)
    progress.publish_report(rows(spark, BATCHES[1]), root, 1, 600)
    assert sorted(map(tuple, progress.read_reports(spark, root).collect())) == WANT


def test_a_query_reports_over_restarts(spark):
    folder = storage.fresh_dir(spark, "reports")
    for i, batch in enumerate(BATCHES[:2]):
        storage.publish(rows(spark, batch), f"{folder}/in", i)
        source = published.stream(spark, f"{folder}/in", rows(spark, []).schema)
        lifecycle.run_available(progress.reports(source, f"{folder}/out", f"{folder}/state", 600))
    assert sorted(map(tuple, progress.read_reports(spark, f"{folder}/out").collect())) == WANT[:2]


def test_the_listener_agrees_with_spark(spark):
    """Spark drops as many rows of a plain aggregate as the reports say."""
    folder = storage.fresh_dir(spark, "reports")
    seen = progress.Progress()
    spark.streams.addListener(seen)
    try:
        for i, batch in enumerate(BATCHES[:2]):
            storage.publish(rows(spark, batch), f"{folder}/in", i)
        source = published.stream(spark, f"{folder}/in", rows(spark, []).schema)
        counts = cadence.segment_counts(source, delay=600)
        lifecycle.run_available(lifecycle.file_writer(counts, f"{folder}/out", f"{folder}/state").queryName("counts"))
        spark._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(seen)
    mine = [b for b in seen.batches if b["name"] == "counts"]
    assert sum(b["rows"] for b in mine) >= 8 and all(b["late"] == 0 for b in mine if b["batch_id"] == 0)
    assert mine[0].keys() >= {"batch_id", "state_rows", "expired_rows", "watermark"}


def test_the_listener_keeps_the_newest():
    class Event:
        class progress:
            name, batchId, numInputRows, stateOperators, eventTime = "q", 0, 1, [], {}

    seen = progress.Progress(keep=2)
    for i in range(4):
        Event.progress.batchId = i
        seen.onQueryProgress(Event)
    assert [b["batch_id"] for b in seen.batches] == [2, 3]


def test_observed_rows(spark):
    seen_rows, seen = progress.observed(rows(spark, BATCHES[1]), "batch")
    assert seen_rows.agg(F.count("*")).first()[0] == 5
    assert seen.get == {"rows": 5, "oldest": second(100), "newest": second(1_200)}

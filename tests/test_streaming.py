import os
import random
import time
import uuid
from datetime import datetime, timedelta
from pathlib import Path

import golden
import pytest
from pyspark.sql import functions as F

from namepulse import schemas
from namepulse.operators import changelog, rolling as batch_rolling
from namepulse.sinks import streams as stream_sinks
from namepulse.sources import streams
from namepulse.streaming import intake, lifecycle, rolling, storage, topk
from test_rolling import EPOCH, mentions, random_mentions
from test_segments import START, write_segment

# The first watermark is the epoch: what is not after it counts as late.
SHIFT = 86_400
MENTION = "id long, name string, timestamp timestamp"


def append_batches(frames, folder):
    """One file per frame, ten seconds apart for the file source."""
    known = set(Path(folder).glob("part-*"))
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(folder)
        for new in set(Path(folder).glob("part-*")) - known:
            at = time.time() - 10_000 + 10 * (len(known) + 1)
            os.utime(new, (at, at))
            known.add(new)


def write_batches(spark, folder, batches):
    shifted = [[(name, sec + SHIFT) for name, sec in rows] for rows in batches]
    append_batches([mentions(spark, rows) for rows in shifted], folder)


def run_changes(spark, folder, delay=rolling.DELAY):
    source = (
        spark.readStream.schema(MENTION).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    )
    changes = rolling.rolling_changes(source, delay)
    lifecycle.run_available(
        lifecycle.file_writer(changes, f"{folder}/changes", f"{folder}/state")
    )
    return spark.read.schema(schemas.COUNT_CHANGES).parquet(f"{folder}/changes")


def rows_of(changes):
    expanded = batch_rolling.expand_changes(changes)
    return sorted(
        (r.event_sec - SHIFT, r["name"], r["count"], r.op) for r in expanded.collect()
    )


def folder_of(spark):
    return storage.fresh_dir(spark, "test")


def test_golden_changes(spark):
    folder = folder_of(spark)
    # The last mention only moves time past the last expiry.
    batches = [[m] for m in golden.ROLLING_INPUT[:1]]
    batches += [golden.ROLLING_INPUT[1:3], golden.ROLLING_INPUT[3:], [("z", 10_800)]]
    write_batches(spark, f"{folder}/in", batches)
    got = [r for r in rows_of(run_changes(spark, folder)) if r[1] != "z"]
    assert got == sorted(golden.ROLLING_CHANGES)


def test_batches_in_time_order_equal_the_batch_form(spark):
    folder = folder_of(spark)
    rows = sorted(random_mentions(11), key=lambda m: m[1])
    cuts = [0, 40, 200, 210, 399, 400]
    write_batches(spark, f"{folder}/in", [rows[a:b] for a, b in zip(cuts, cuts[1:])])
    last = rows[-1][1]
    want = [
        w for w in golden.brute_force_changes(rows) if w[3] == "add" or w[0] <= last
    ]
    assert rows_of(run_changes(spark, folder)) == want


def live_counts(changes):
    latest = changelog.latest_counts(changes).where("count > 0")
    return {r["name"]: r["count"] for r in latest.collect()}


def histogram(rows):
    newest, out = max(s for _, s in rows), {}
    for name, sec in rows:
        if sec > newest - 3600:
            out[name] = out.get(name, 0) + 1
    return out


@pytest.mark.parametrize("size", [400, 80, 57])
@pytest.mark.parametrize("per_arrow_batch", [1, 10_000])
def test_out_of_order_in_batches_of_any_size(spark, size, per_arrow_batch):
    """Mentions come up to 70 minutes late; nothing is lost, and the newest counts are right."""
    folder = folder_of(spark)
    r = random.Random(5)
    rows = sorted(random_mentions(12), key=lambda m: m[1] + r.randrange(4200))
    write_batches(spark, f"{folder}/in", [rows[i : i + size] for i in range(0, 400, size)])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, per_arrow_batch)
    try:
        changes = run_changes(spark, folder)
    finally:
        spark.conf.set(key, before)
    assert live_counts(changes) == histogram(rows)
    added = changes.where("op = 'add'").agg(F.sum(F.col("count") - F.col("prev_count"))).first()
    assert added[0] == 400
    # Of each name, what a change finds is what the one before has left.
    for name in {n for n, _ in rows}:
        own = changes.where(F.col("name") == name).orderBy("seq").collect()
        assert len({c.seq for c in own}) == len(own)
        assert [c["prev_count"] for c in own] == [0, *[c["count"] for c in own[:-1]]]


def test_mentions_of_a_filled_gap_count(spark):
    """Five mentions of a segment that comes 15 minutes after the next one: ten of ten."""
    folder = folder_of(spark)
    now, gap = [("a", 9000 + i) for i in range(5)], [("a", 8100 + i) for i in range(5)]
    write_batches(spark, f"{folder}/in", [now, gap, [("z", 9010)]])
    assert live_counts(run_changes(spark, folder)) == {"a": 10, "z": 1}


def test_older_change_with_the_newer_count(spark):
    """A mention at an earlier second comes second: its count is the newer one."""
    folder = folder_of(spark)
    write_batches(spark, f"{folder}/in", [[("a", 100)], [("a", 99)]])
    changes = run_changes(spark, folder)
    assert [(c.event_sec - SHIFT, c["count"]) for c in changes.orderBy("seq").collect()] == [(100, 1), (99, 2)]
    assert live_counts(changes) == {"a": 2}
    root = f"{folder}/topk"
    topk.update_snapshot(changes, 0, root, k=3)
    assert [tuple(r) for r in topk.read_snapshot(spark, root)[1].collect()] == [("a", 2)]


def test_mention_older_than_its_hour_is_added_and_expires(spark):
    """As in the batch form, both changes are written."""
    folder = folder_of(spark)
    write_batches(spark, f"{folder}/in", [[("a", 7000)], [("a", 3000)]])
    got = [r for r in rows_of(run_changes(spark, folder)) if r[1] == "a"]
    assert sorted((s, o) for s, _, _, o in got) == [(3000, "add"), (6600, "expire"), (7000, "add")]


def test_name_that_comes_back_goes_on_with_larger_seq(spark):
    folder = folder_of(spark)
    days = [[("a", 0)], [("z", 20_000)], [("z", 20_001)], [("a", 90_000)], [("z", 90_001)]]
    write_batches(spark, f"{folder}/in", days)
    changes = run_changes(spark, folder)
    own = changes.where("name = 'a'").orderBy("event_sec").collect()
    assert [(c.event_sec - SHIFT, c["count"]) for c in own] == [(0, 1), (3600, 0), (90_000, 1)]
    assert [c.seq for c in own] == sorted({c.seq for c in own})


def test_too_late_mention_is_dropped(spark):
    folder = folder_of(spark)
    write_batches(spark, f"{folder}/in", [[("a", 7140)], [("b", 7200)], [("a", 100)]])
    assert rows_of(run_changes(spark, folder)) == [(7140, "a", 1, "add"), (7200, "b", 1, "add")]


def test_same_time_in_later_batches_is_not_late(spark):
    """Many lines may share one time; by default none of them is dropped."""
    folder = folder_of(spark)
    write_batches(spark, f"{folder}/in", [[("a", 50)], [("a", 50), ("b", 50)], [("a", 50)]])
    source = (
        spark.readStream.schema(MENTION).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    )
    writer = lifecycle.file_writer(
        rolling.rolling_changes(source), f"{folder}/changes", f"{folder}/state"
    )
    lifecycle.run_available(writer)
    changes = spark.read.schema(schemas.COUNT_CHANGES).parquet(f"{folder}/changes")
    assert rows_of(changes) == [
        (50, "a", 1, "add"),
        (50, "a", 2, "add"),
        (50, "a", 3, "add"),
        (50, "b", 1, "add"),
    ]


def test_rows_without_a_time_do_not_stop_the_stream(spark):
    folder = folder_of(spark)
    at = EPOCH + timedelta(seconds=SHIFT + 5)
    rows = [(1, "a", None), (2, None, at), (3, "a", at), (4, "b", None)]
    append_batches([spark.createDataFrame(rows, MENTION)], f"{folder}/in")
    assert rows_of(run_changes(spark, folder)) == [(5, "a", 1, "add")]


def test_restart_goes_on_where_it_stopped(spark):
    folder = folder_of(spark)
    write_batches(spark, f"{folder}/in", [[("a", 0), ("a", 10)]])
    run_changes(spark, folder)
    write_batches(spark, f"{folder}/in", [[("a", 20), ("b", 3605)]])
    assert rows_of(run_changes(spark, folder)) == [
        (0, "a", 1, "add"),
        (10, "a", 2, "add"),
        (20, "a", 3, "add"),
        (3600, "a", 2, "expire"),
        (3605, "b", 1, "add"),
    ]


def changes_of(spark, rows, first=0):
    data = [(n, i, "add", c - 1, c, first + i) for i, (n, c) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.COUNT_CHANGES)


def test_top_k_trace(spark):
    root = folder_of(spark)
    steps = [
        (("x", 3), {("x", 3)}, {"x": 3}),
        (("y", 5), {("y", 5)}, {"y": 5, "x": 3}),
        (("z", 3), set(), {"y": 5, "x": 3}),
        (("z", 4), {("z", 4), ("x", 0)}, {"y": 5, "z": 4}),
        (("y", 1), {("x", 3), ("y", 0)}, {"z": 4, "x": 3}),  # x comes back without a change
        (("w", 3), {("w", 3), ("x", 0)}, {"z": 4, "w": 3}),
        (("z", 0), {("x", 3), ("z", 0)}, {"w": 3, "x": 3}),
    ]
    for batch_id, (update, delta, snapshot) in enumerate(steps):
        changes = changes_of(spark, [update], first=batch_id)
        topk.update_snapshot(changes, batch_id, root, k=2)
        # A batch that is run again changes nothing.
        topk.update_snapshot(changes, batch_id, root, k=2)
        at, held = topk.read_snapshot(spark, root)
        assert at == batch_id
        assert {r["name"]: r["count"] for r in held.collect()} == snapshot
        new = topk.read_deltas(spark, root, after=batch_id - 1)
        assert sorted((r["name"], r["count"]) for r in new.collect()) == sorted(delta)

    messages = {r.batch_id: r.message for r in topk.read_messages(spark, root).collect()}
    assert messages[3] == '[{"name":"x","count":0},{"name":"z","count":4}]'
    assert 2 not in messages
    replayed = changelog.materialise(topk.read_deltas(spark, root), "batch_id")
    assert {r["name"]: r["count"] for r in replayed.collect()} == {"w": 3, "x": 3}
    text = topk.snapshot_message(topk.read_snapshot(spark, root)[1]).collect()
    assert [r.message for r in text] == ['[{"name":"w","count":3},{"name":"x","count":3}]']


@pytest.mark.parametrize("size", [1, 7, 60])
def test_top_k_does_not_depend_on_batches(spark, size):
    root = folder_of(spark)
    r = random.Random(4)
    updates = [(f"n{r.randrange(12)}", r.randrange(0, 9)) for _ in range(60)]
    for i in range(0, 60, size):
        if i and size == 1 and i < 50:
            continue  # one by one for the last ten only
        rows = updates[i : i + size] if size > 1 or i else updates[:50]
        topk.update_snapshot(changes_of(spark, rows, first=i), i, root, k=4)
    truth = dict(updates)
    want = sorted(((n, c) for n, c in truth.items() if c), key=lambda x: (-x[1], x[0]))[:4]
    assert {tuple(x) for x in topk.read_snapshot(spark, root)[1].collect()} == set(want)


def test_snapshot_then_deltas_equals_later_snapshot(spark):
    """A subscriber that starts in the middle ends up with the same entries."""
    root = folder_of(spark)
    r = random.Random(2)
    updates = [[(f"n{r.randrange(9)}", r.randrange(0, 30))] for _ in range(14)]
    for i, rows in enumerate(updates):
        topk.update_snapshot(changes_of(spark, rows, first=i), i, root, k=4, keep_seconds=1.5)
        if i == 6:
            at, start = topk.read_snapshot(spark, root)
            held = {row["name"]: row["count"] for row in start.collect()}
    rows = topk.read_deltas(spark, root, after=at).orderBy("batch_id").collect()
    for row in rows:
        held[row["name"]] = row["count"]
    held = {n: c for n, c in held.items() if c}
    final = topk.read_snapshot(spark, root)[1].collect()
    assert held == {row["name"]: row["count"] for row in final}
    kept = storage.versions(spark, f"{root}/snapshots")
    assert 2 <= len(kept) < 14 and kept[-1] == 13


def test_deltas_are_read_from_their_block_on(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BATCHES", 2)
    root = folder_of(spark)
    assert topk.read_deltas(spark, root).count() == 0
    for i in range(5):
        topk.update_snapshot(changes_of(spark, [("x", i + 1)], first=i), i, root, k=2)
    later = topk.read_deltas(spark, root, after=3)
    assert [tuple(r) for r in later.collect()] == [(4, "x", 5)]
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan
    assert {r.split("=")[1] for r in os.listdir(f"{root}/deltas".removeprefix("file:")) if "=" in r} == {"0", "1", "2"}


def test_half_written_version_is_neither_read_nor_done(spark):
    root = folder_of(spark)
    storage.publish(spark.range(3), root, 1)
    spark.range(9).write.parquet(storage.version_path(root, 2))
    os.remove(f"{storage.version_path(root, 2)}/_SUCCESS".removeprefix("file:"))
    assert storage.versions(spark, root) == [1]
    assert storage.newest_version(spark, root) == 1
    assert storage.newest_version(spark, root, before=1) is None
    storage.publish(spark.range(4), root, 2)
    assert storage.versions(spark, root) == [1, 2]
    assert spark.read.parquet(storage.version_path(root, 2)).count() == 4


def test_the_two_newest_versions_always_stay(spark):
    root = folder_of(spark)
    for i in range(4):
        storage.publish(spark.range(1), root, i)
    storage.drop_versions(spark, root, keep_seconds=-1)
    assert storage.versions(spark, root) == [2, 3]


def test_from_segment_files_to_live_top_k(spark, tmp_path):
    """Intake, rolling counts and top K, one after the other."""
    folder, segment_dir = folder_of(spark), tmp_path / "segment"
    segment_dir.mkdir()

    def take_in():
        lines = streams.segment_stream(
            spark, str(segment_dir), streams.file_options(1, "*.gkg.csv")
        )
        lifecycle.run_available(intake.intake(lines, f"{folder}/log", f"{folder}/log-state"))

    write_segment(segment_dir, START + timedelta(minutes=15), 9)
    take_in()
    write_segment(segment_dir, START, 30)  # fills a gap: it is still taken
    write_segment(segment_dir, START + timedelta(minutes=30), 3)
    (segment_dir / "20150219000000.gkg.csv").write_text("")
    take_in()
    log = streams.record_log(spark, intake.log_glob(f"{folder}/log"))
    assert log.count() == log.select("key").distinct().count() == 42

    source = streams.record_stream(spark, intake.log_glob(f"{folder}/log"))
    changes = rolling.rolling_changes(rolling.record_mentions(source))
    lifecycle.run_available(
        lifecycle.file_writer(changes, f"{folder}/changes", f"{folder}/changes-state")
    )
    stream = streams.change_stream(spark, f"{folder}/changes")
    lifecycle.run_available(
        topk.live_top_k(stream, f"{folder}/topk", f"{folder}/topk-state", k=2)
    )
    held = topk.read_snapshot(spark, f"{folder}/topk")[1].collect()
    assert sorted((r["name"], r["count"]) for r in held) == [("Name0", 14), ("Name1", 14)]


def test_published_batch_is_not_written_twice(spark):
    root = folder_of(spark)
    storage.publish(spark.range(3), root, 4)
    storage.publish(spark.range(9), root, 4)
    assert spark.read.parquet(storage.version_path(root, 4)).count() == 3
    assert storage.versions(spark, root) == [4]


def test_record_mentions(spark):
    lines = spark.createDataFrame(
        [(r.split("\t")[0], r, EPOCH, i) for i, r in enumerate(golden.RECORDS)],
        schemas.RECORD_STREAM,
    )
    got = {}
    for r in rolling.record_mentions(lines).collect():
        got.setdefault(r.key, []).append(r["name"])
    assert got == {
        "20150218230000-0": ["Alice Ames", "Bob Bell", "Alice Ames"],
        "20150218230000-1": ["Bob Bell", "Cara Cole"],
        "20150219000000-0": ["Cara Cole", "Dan-Dee Doe"],
    }


def test_running_increments_as_a_stream(spark):
    folder = folder_of(spark)
    schema = "name string, increment long"
    batches = [("a", 1), ("b", 2)], [("a", 4)]
    append_batches([spark.createDataFrame(b, schema) for b in batches], f"{folder}/in")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = f"q{uuid.uuid4().hex}"
    writer = changelog.increment_totals(source).writeStream.outputMode("update")
    lifecycle.run_available(
        writer.format("memory").queryName(query).option("checkpointLocation", f"{folder}/state")
    )
    got = sorted((r["name"], r["count"]) for r in spark.table(query).collect())
    assert got == [("a", 1), ("a", 5), ("b", 2)]


def test_stop(spark):
    folder = folder_of(spark)
    write_batches(spark, f"{folder}/in", [[("a", 1)]])
    source = spark.readStream.schema(MENTION).parquet(f"{folder}/in")
    writer = lifecycle.file_writer(source, f"{folder}/out", f"{folder}/state")
    query = lifecycle.per_second(writer).start()
    query.processAllAvailable()
    assert query.isActive
    assert lifecycle.stop(query)
    assert not query.isActive


def test_kafka_rows_and_options(spark):
    rows = spark.createDataFrame(
        [("k", "line", datetime(2015, 2, 18, 23, 3, 45, 500_000), 7)], schemas.RECORD_STREAM
    )
    sent = stream_sinks.record_messages(rows, partition=0)
    assert sent.columns == ["key", "value", "headers", "partition"]
    read = sent.withColumn("timestamp", F.lit(None).cast("timestamp"))
    back = read.select(streams.event_time(read).alias("t")).first()["t"]
    assert back == datetime(2015, 2, 18, 23, 3, 45, 500_000)

    changes = changes_of(spark, [("x", 3)])
    messages = stream_sinks.change_messages(changes)
    assert streams.parse_changes(messages).collect() == changes.collect()

    assert streams.kafka_options("t", "h:1", "latest", 500) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "includeHeaders": "true",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "500",
    }
    assert stream_sinks.kafka_writer_options("t", "/c", "h:1") == {
        "kafka.bootstrap.servers": "h:1",
        "topic": "t",
        "checkpointLocation": "/c",
    }


def test_increments_of_hot_name_reach_the_state_as_few_rows(spark):
    """Mentions are added up per batch of rows before the shuffle."""
    import pyarrow as pa

    from namepulse.streaming.state import combine_buckets

    batch = pa.record_batch(
        {
            "name": ["hot"] * 900 + ["b"] * 100,
            "sec": [1] * 500 + [2] * 500,
            "n": [1] * 1000,
            "timestamp": [EPOCH + timedelta(milliseconds=i) for i in range(1000)],
        }
    )
    rows = [r for out in combine_buckets(iter([batch])) for r in out.to_pylist()]
    assert {(r["name"], r["sec"], r["n"]) for r in rows} == {
        ("hot", 1, 500),
        ("hot", 2, 400),
        ("b", 2, 100),
    }
    newest = {(r["name"], r["sec"]): r["timestamp"] for r in rows}
    assert newest["hot", 2] == EPOCH + timedelta(milliseconds=899)


@pytest.mark.parametrize("path", ["table.parquet", "table.parquet/part.parquet"])
def test_table_as_stream(spark, tmp_path, path):
    folder = folder_of(spark)
    (tmp_path / path).parent.mkdir(exist_ok=True)
    spark.range(5).toPandas().to_parquet(tmp_path / path)
    stream = streams.table_stream(spark, str(tmp_path / "table.parquet"), "id long")
    lifecycle.run_available(lifecycle.file_writer(stream, f"{folder}/out", f"{folder}/state"))
    assert spark.read.parquet(f"{folder}/out").count() == 5


def test_work_dir_is_the_shared_folder(spark):
    assert storage.work_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("pace", [lifecycle.per_segment, lifecycle.per_second])
def test_a_paced_query_begins_at_once(spark, pace):
    """The first batch does not wait for the interval to pass."""
    folder = folder_of(spark)
    write_batches(spark, f"{folder}/in", [[("a", 1)]])
    source = spark.readStream.schema(MENTION).parquet(f"{folder}/in")
    query = pace(lifecycle.file_writer(source, f"{folder}/out", f"{folder}/state")).start()
    end = time.time() + 60
    while not query.recentProgress and time.time() < end:
        time.sleep(0.1)
    assert spark.read.parquet(f"{folder}/out").count() == 1
    assert lifecycle.stop(query)


def test_files_per_trigger_limit_a_batch(spark):
    folder = folder_of(spark)
    streams.write_slices(spark.range(9), f"{folder}/in", (F.col("id") % 3).cast("int"), 3)
    source = streams._load(spark.readStream, "parquet", streams.file_options(1), "id long", f"{folder}/in")
    seen = []
    writer = source.writeStream.option("checkpointLocation", f"{folder}/state").foreachBatch(
        lambda batch, _: seen.append(sorted(r.id for r in batch.collect()))
    )
    lifecycle.run_available(writer)
    assert seen == [[0, 3, 6], [1, 4, 7], [2, 5, 8]]


def test_slices_are_many_files_and_one_batch_each(spark):
    folder = folder_of(spark)
    seen, files = [], []

    def run():
        source = spark.readStream.schema("id long").parquet(f"{folder}/in")
        writer = source.writeStream.option("checkpointLocation", f"{folder}/state").foreachBatch(
            lambda batch, k: seen.append((k, sorted(r.id for r in batch.collect())))
        )
        lifecycle.run_available(writer)
        files.append(len(spark.read.parquet(f"{folder}/in").inputFiles()))

    df = spark.range(0, 600, 1, 4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        streams.write_slices(df, f"{folder}/in", (F.col("id") % 3).cast("int"), 3, run)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen == [(k, list(range(k, 600, 3))) for k in range(3)]
    assert files[0] > 1 and files == sorted(set(files))


def test_topics_need_the_connector(spark):
    """Without it the writers say so; with it they would send these rows."""
    rows = stream_sinks.change_messages(changes_of(spark, [("x", 3)]))
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_sinks.write_to_kafka(rows, stream_sinks.kafka_writer_options("t"))

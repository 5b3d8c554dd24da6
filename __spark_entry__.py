"""

Names come from two tables. `documents`: the capitalised words of a text are the names of
one record, dated 2024-01-01 + doc_id % 30. `events`: event_type or user_id is the name
mentioned at ts; event_id orders the mentions.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

sys.path.insert(0, str(Path(__file__).resolve().parent))

from namepulse import schemas  # noqa: E402
from namepulse.functions import messages, text, times  # noqa: E402
from namepulse.operators import changelog, daily, log, rolling  # noqa: E402
from namepulse.plans import daily as daily_plans, refresh  # noqa: E402
from namepulse.plans.session import bytes_below, configure  # noqa: E402
from namepulse.sinks import daily as daily_sinks, streams as stream_sinks  # noqa: E402
from namepulse.sources import footers, records, segments, streams, tables, timed  # noqa: E402
from namepulse.streaming import cadence, intake, lifecycle, progress, published, storage, topk  # noqa: E402
from namepulse.streaming import rolling as stream_rolling  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

AS_OF = "2024-01-15 12:00:00"
AS_OF_TICK = 1705320000  # AS_OF in epoch seconds, a quarter-hour
TICK = 900
K = 10

Query = Callable[[SparkSession, str], DataFrame]


# --- input views -------------------------------------------------------------------


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return tables.document_records(tables.documents(spark, sf))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return tables.document_lines(tables.documents(spark, sf))


def _counts(spark: SparkSession, sf: str, **options) -> DataFrame:
    found = daily_plans.record_mentions(_records(spark, sf), **options)
    return daily.daily_counts(found)


def _types(spark: SparkSession, sf: str) -> DataFrame:
    return tables.event_mentions(tables.events(spark, sf))


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return tables.event_mentions(tables.events(spark, sf), "user_id")


def _user_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.top_k_by_tick(rolling.histogram_by_tick(_users(spark, sf)), K)


def _user_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.tick_deltas(_user_ticks(spark, sf), TICK)


def _event_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tables.event_lines(tables.events(spark, sf))


def _time_text(c: str) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# --- per day -----------------------------------------------------------------------


def daily_top_names(spark, sf):
    return daily_plans.top_names_of_records(_records(spark, sf))


def daily_name_counts(spark, sf):
    return _counts(spark, sf)


def daily_name_counts_filtered(spark, sf):
    return _counts(spark, sf, exclude=("Th", "ie"), drop_empty=True)


def daily_top_names_one_per_count(spark, sf):
    return daily.top_names(_counts(spark, sf), ties="one_per_count")


def line_top_names(spark, sf):
    return daily_plans.top_names_of_lines(_lines(spark, sf))


def typed_record_top_names(spark, sf):
    parsed = records.parse_records(_lines(spark, sf))
    return daily_plans.top_names_of_records(records.record_view(parsed))


def line_view_top_names(spark, sf):
    return daily_plans.top_names_of_records(records.line_view(_lines(spark, sf)))


def daily_result_lines(spark, sf):
    return daily_sinks.result_lines(daily.day_pairs(line_top_names(spark, sf)))


def daily_top_names_refreshed(spark, sf):
    """Documents as three segments, added one by one; the second came without half its lines first."""
    root = storage.fresh_dir(spark, "refreshed")
    found = _records(spark, sf).withColumn("_part", F.pmod(F.xxhash64("record_id"), F.lit(6)))
    for segment, parts in (("a", (0, 1)), ("b", (2,)), ("c", (4, 5)), ("b", (2, 3))):
        own = daily_plans.record_mentions(found.where(F.col("_part").isin(*parts)))
        refresh.add_segment(own, segment, root)
    return refresh.read_top(spark, root)


def daily_lines_of_paths(spark, sf):
    """Lines from the path that the environment names, results to the other one."""
    folder = storage.fresh_dir(spark, "paths")
    _lines(spark, sf).select("value").write.text(f"{folder}/in")
    paths = {"DATA_PATH": f"{folder}/in", "OUT_PATH": f"{folder}/out"}
    before = {name: os.environ.get(name) for name in paths}
    os.environ.update(paths)
    try:
        daily_plans.write_top_names_of_lines(spark)
    finally:
        for name, value in before.items():
            os.environ.pop(name) if value is None else os.environ.update({name: value})
    return spark.read.text(f"{folder}/out")


def daily_display_lines(spark, sf):
    return daily_sinks.display_lines(daily.day_pairs(daily_top_names(spark, sf)))


def daily_counts_keep_empty(spark, sf):
    """Counts of the names without any of these letters; a 0 row marks the left-out rest."""
    return _counts(
        spark, sf, exclude=tuple("abcdghiklmnoprstuvwz"), keep_empty_days=True
    ).withColumn("name", F.coalesce("name", F.lit("")))


def sorted_name_counts(spark, sf):
    return daily.sorted_by_count(_counts(spark, sf))


def daily_documents(spark, sf):
    documents = daily.daily_documents(daily.day_pairs(daily_top_names(spark, sf)))
    return documents.select("data", F.to_json("result").alias("result"))


def ranked_cells(spark, sf):
    documents = daily.daily_documents(daily.day_pairs(daily_top_names(spark, sf)))
    return daily.ranked_cells(documents).withColumn("date", F.col("date").cast("string"))


def record_name_counts(spark, sf):
    found = daily.mentions(_records(spark, sf), keep=["record_id"])
    return daily.record_counts(found, "record_id")


def record_name_lists(spark, sf):
    """The names of each record in their order."""
    listed = _records(spark, sf).where("all_names IS NOT NULL").select(
        "record_id", text.name_list("all_names", exclude=("Th",)).alias("names")
    )
    return listed.select(
        "record_id",
        F.array_join("names", "|").alias("names"),
        F.size("names").cast("bigint").alias("n"),
    )


def result_bounds(spark, sf):
    return daily.result_bounds(_counts(spark, sf))


# --- lines, keys, segments -----------------------------------------------------------


def min_fields_filter(spark, sf):
    documents = tables.table(spark, sf, "documents").select("doc_id", "text")
    return records.with_min_fields(documents, "text", " ", 23).select("doc_id")


def clean_text(spark, sf):
    """Each text with a malformed byte put before and after it, cleaned again."""
    raw = tables.table(spark, sf, "documents").select("doc_id", "text")
    bad = F.unhex(F.lit("FF"))
    broken = F.concat(bad, F.col("text").cast("binary"), bad).cast("string")
    return raw.select("doc_id", text.drop_malformed_utf8(broken).alias("text"))


def union_segments(spark, sf):
    """Lines of several files in one scan."""
    names = ("documents", "conversations", "benchmark")
    rows = spark.read.schema("text string").parquet(*[f"{sf}/{n}.parquet" for n in names])
    lines = rows.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/([a-z]+\.parquet)(/|$)", 1).alias(
            "file_name"
        ),
        F.explode(F.split("text", "\n")).alias("line"),
    )
    return lines.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars")
    )


def record_key_parse(spark, sf):
    event_id = F.col("event_id").cast("string")
    shape = F.col("event_id") % 6
    key = (
        F.when(shape == 0, F.concat(F.col("event_type"), F.lit("-"), event_id))
        .when(shape == 1, F.concat(F.lit("1-2-"), event_id))
        .when(shape == 2, F.concat(event_id, F.lit("-")))
        .when(shape == 3, F.concat(F.lit("-"), event_id))
        .when(shape == 4, F.concat(F.lit("7-"), event_id, F.lit("--")))
        .otherwise(F.concat(F.date_format("ts", "yyyyMMddHHmmss"), F.lit("-"), event_id))
    )
    keyed = tables.events(spark, sf).select("event_id", key.alias("key"))
    parsed = keyed.select(
        "event_id",
        text.first_field("key", "-").alias("head"),
        text.record_key("key").alias("k"),
    )
    return parsed.select("event_id", "head", "k.time", "k.seq")


def exact_timestamp(spark, sf):
    found = records.at_timestamp(
        tables.orders(spark, sf), "1998-10-03 00:00:00", "o_orderdate"
    )
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


def sensor_readings(spark, sf):
    """Events written as sensor lines and parsed again, at one minute of the clock face."""
    number = F.col("event_id").cast("string")
    line = F.concat_ws(
        ",",
        F.col("event_type"),
        F.date_format("ts", "MM/dd/yy:hh:mm"),
        F.col("value").cast("string"),
        number,
        number,
        number,
        F.col("user_id").cast("string"),
        number,
    )
    parsed = records.parse_sensors(tables.events(spark, sf).select(line.alias("value")))
    return parsed.select(
        "sensorname",
        _time_text("timestamp").alias("timestamp"),
        "numA",
        "numC",
        "numE",
    )


def segment_names(spark, sf):
    """How many events would list each segment file."""
    named = segments.segments_in_window(tables.events(spark, sf), "ts")
    return named.groupBy("file_name").agg(F.count(F.lit(1)).alias("listings"))


def segment_index(spark, sf):
    pages = tables.table(spark, sf, "pages").select("page_id", "url")
    return segments.segment_index(
        pages,
        100,
        ["page_id"],
        value="url",
        base="files:/",
        path_pattern=r"/[a-z]+/[0-9]+",
        name_pattern=r"[0-9]+",
    )


def next_boundary(spark, sf):
    return tables.events(spark, sf).select(
        "event_id",
        _time_text(times.floor_to("ts")).alias("quarter"),
        _time_text(times.next_boundary("ts")).alias("next_quarter"),
        times.whole_seconds("ts").alias("secs"),
    )


def spread_event_times(spark, sf):
    spread = segments.spread_in_order(
        _event_lines(spark, sf), ["segment"], "event_id", times.segment_start_of_key("key")
    )
    return spread.select("event_id", "segment", "position", "total", "event_ms")


def new_segments_only(spark, sf):
    newer = segments.newer_than(_event_lines(spark, sf), "20240110120000", "segment")
    return newer.groupBy("segment").agg(F.count(F.lit(1)).alias("lines"))


def timed_segments(spark, sf):
    """Lines of the five days before AS_OF, from files of a day each that the window plans."""
    folder = storage.fresh_dir(spark, "timed")
    days = F.date_format("ts", "yyyyMMdd000000").alias("day")
    events = tables.events(spark, sf).select(F.col("event_id").cast("string").alias("value"), days)
    events.write.partitionBy("day").text(folder)
    until = datetime.fromisoformat(AS_OF)
    lines = timed.read_timed(spark, folder, until - timedelta(days=5), until, "day={}", 24 * 60)
    return lines.groupBy(_time_text("segment").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("value").cast("long")).alias("ids")
    )


def last_key(spark, sf):
    return log.last_key(_event_lines(spark, sf), "key", "event_id")


def newest_event(spark, sf):
    """The event with the largest id, which the footers tell."""
    newest = footers.newest_rows(spark, f"{sf}/events.parquet", "event_id", tables.EVENTS)
    return newest.select("event_id", "user_id", "event_type", _time_text("ts").alias("ts"))


def event_bounds(spark, sf):
    """The events with the first and the last id, and how many there are, from footers."""
    low, high, rows = footers.bounds(spark, f"{sf}/events.parquet", "event_id", tables.EVENTS)
    ends = tables.events(spark, sf).where(F.col("event_id").isin(low, high))
    return ends.select(
        "event_id", (F.col("event_id") == F.lit(high)).alias("is_last"), F.lit(rows).cast("bigint").alias("events")
    )


# --- rolling hour --------------------------------------------------------------------


def rolling_hour_adds(spark, sf):
    return rolling.rolling_adds(_types(spark, sf), "event_id")


def rolling_hour_adds_by_user(spark, sf):
    return rolling.rolling_adds(_users(spark, sf), "event_id")


def rolling_hour_changelog(spark, sf):
    return rolling.rolling_changelog(_types(spark, sf))


def histogram_as_of(spark, sf):
    return rolling.histogram_as_of(_types(spark, sf), AS_OF)


def histogram_by_tick(spark, sf):
    return rolling.histogram_by_tick(_types(spark, sf))


def coalesced_updates(spark, sf):
    return changelog.coalesced_updates(rolling.rolling_changes(_types(spark, sf)), 60)


# --- top K ---------------------------------------------------------------------------


def topk_snapshot(spark, sf):
    return changelog.top_k(rolling.histogram_as_of(_users(spark, sf), AS_OF), K)


def topk_by_tick(spark, sf):
    return _user_ticks(spark, sf)


def topk_bounds(spark, sf):
    return changelog.snapshot_bounds(_user_ticks(spark, sf), "tick")


def topk_deltas(spark, sf):
    return _user_deltas(spark, sf)


def update_messages(spark, sf):
    return changelog.update_messages(_user_deltas(spark, sf), "tick")


def parsed_messages(spark, sf):
    sent = changelog.update_messages(_user_deltas(spark, sf), "tick")
    return changelog.parse_messages(sent, "tick")


def materialised_changelog(spark, sf):
    """All deltas up to a time, replayed: equals the snapshot of that time."""
    until = _user_deltas(spark, sf).where(F.col("tick") <= AS_OF_TICK)
    return changelog.ordered_snapshot(changelog.materialise(until, "tick"))


def running_increments(spark, sf):
    updates = tables.events(spark, sf).select(
        F.col("event_type").alias("name"), F.floor("value").alias("increment")
    )
    return changelog.increment_totals(updates)


def increment_messages(spark, sf):
    """Increments as single JSON objects, decoded and added up."""
    increment = F.get_json_object("props", "$.k").cast("bigint").alias("increment")
    message = F.to_json(F.struct(F.col("event_type").alias("name"), increment))
    updates = tables.events(spark, sf).select(message.alias("message"))
    parsed = updates.select(
        F.inline(messages.parse_increments("message")).alias("name", "increment")
    )
    return changelog.increment_totals(parsed)


# --- streaming -----------------------------------------------------------------------
# Each query reads its table as a stream, processes what is there, and returns the table
# it wrote. The watermark ends at the newest event, so later expiries are still to come.


def _run_changes(events: DataFrame, name: str, folder: str) -> None:
    changes = stream_rolling.rolling_changes(tables.event_mentions(events, name))
    lifecycle.run_available(
        lifecycle.file_writer(changes, f"{folder}/changes", f"{folder}/changes-state")
    )


def _changes_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.COUNT_CHANGES).parquet(f"{folder}/changes")


def _stream_changes(spark: SparkSession, sf: str, name: str, folder: str) -> DataFrame:
    configure(spark, streaming=True)
    events = streams.table_stream(spark, f"{sf}/events.parquet", tables.EVENTS)
    _run_changes(events, name, folder)
    return _changes_of(spark, folder)


# Ends of the slices, in epoch seconds, that tables are fed to a stream in.
SLICES = (1704931200, 1705795200, AS_OF_TICK + 5 * 86_400)


# Rows of a slice, about, where more slices change no result: what a batch holds in a task is bounded.
SLICE_ROWS = 2_000_000


def _slice_of(sec: Column, ends: Sequence[int] = SLICES) -> Column:
    """The slice of a second: it ends with ends[k], the last one does not end."""
    passed = F.filter(F.lit(sorted(ends)), lambda end: sec > end)
    return F.when(sec.isNotNull(), F.size(passed))


def _bounded_ends(df: DataFrame, second: Column) -> list[int]:
    """SLICES and as many ends between them as slices of SLICE_ROWS rows need.

    Only a second that has more rows makes a larger slice: such rows are added up by name first.
    """
    parts = -(-df.count() // SLICE_ROWS)
    if parts <= 1:
        return sorted(SLICES)
    at = [k / parts for k in range(1, parts)]
    found = df.agg(F.percentile_approx(second, at, max(10_000, 100 * parts))).first()[0]
    return sorted({*SLICES, *(found or [])})


def _in_slices(
    df: DataFrame,
    folder: str,
    second: Column,
    start: Callable[[DataFrame], DataStreamWriter],
    ends: Sequence[int] = SLICES,
) -> None:
    """Run one query over a table whose slices, by a second, are published one after the other.

    It starts with the first of them, which is its batch 0.
    """
    source = published.stream(df.sparkSession, f"{folder}/in", df.schema)
    running: list[StreamingQuery] = []

    def run() -> None:
        if not running:
            running.append(start(source).start())
        running[0].processAllAvailable()

    try:
        storage.publish_slices(df, f"{folder}/in", _slice_of(second, ends), len(ends) + 1, run)
    finally:
        for query in running:
            lifecycle.stop(query)


def _sliced_changes(
    spark: SparkSession, sf: str, name: str, folder: str, arrives: Column
) -> DataFrame:
    """Rolling counts of events that come in slices of bounded size by their time of arrival."""
    events = tables.events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    configure(spark, streaming=True)

    def start(source: DataFrame) -> DataStreamWriter:
        changes = stream_rolling.rolling_changes(tables.event_mentions(source, name))
        return lifecycle.file_writer(changes, f"{folder}/changes", f"{folder}/changes-state")

    _in_slices(events, folder, arrives, start, _bounded_ends(events, arrives))
    return _changes_of(spark, folder)


def stream_record_mentions(spark, sf):
    folder = storage.fresh_dir(spark, "mentions")
    documents = streams.table_stream(
        spark, f"{sf}/documents.parquet", tables.DOCUMENTS
    )
    found = stream_rolling.record_mentions(tables.document_lines(documents))
    lifecycle.run_available(
        lifecycle.file_writer(found, f"{folder}/mentions", f"{folder}/state")
    )
    mentions = spark.read.schema("key string, timestamp timestamp, name string").parquet(
        f"{folder}/mentions"
    )
    return mentions.groupBy("name").agg(F.count(F.lit(1)).alias("count"))


def stream_published_log(spark, sf):
    """How often a stream of a published log gives each line, and how many names it has.

    The lines are published in three batches. The second loses its marker, the stream runs,
    and the batch is published again under new file names, after the stream and then once more
    when the stream has read it.
    """
    folder = storage.fresh_dir(spark, "published")
    root = f"{folder}/log"
    lines = _lines(spark, sf).withColumn("offset", F.lit(None).cast("bigint"))
    part = F.pmod(F.xxhash64("key"), F.lit(3))

    def publish(batch_id: int) -> None:
        storage.publish(lines.where(part == batch_id), root, batch_id)

    def run() -> None:
        field = F.split_part("value", F.lit("\t"), F.lit(schemas.NAMES_FIELD + 1))
        names = F.size(text.name_list(field, exclude=())).cast("bigint")
        counted = intake.log_stream(spark, root).select("key", names.alias("names"))
        lifecycle.run_available(lifecycle.file_writer(counted, f"{folder}/out", f"{folder}/state"))

    publish(0)
    publish(1)
    storage.unmark(spark, root, 1)
    run()
    publish(2)
    publish(1)
    run()
    storage.unmark(spark, root, 1)
    publish(1)
    run()
    seen = spark.read.schema("key string, names long").parquet(f"{folder}/out")
    return seen.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("names").alias("names")
    )


def stream_rolling_changelog(spark, sf):
    folder = storage.fresh_dir(spark, "rolling")
    in_order = times.whole_seconds("ts")
    return rolling.expand_changes(_sliced_changes(spark, sf, "event_type", folder, in_order))


def stream_out_of_order_histogram(spark, sf):
    """Live counts at the end of a stream in which mentions come up to 40 minutes late."""
    folder = storage.fresh_dir(spark, "late")
    late = times.whole_seconds("ts") + F.pmod("event_id", F.lit(5)) * 600
    changes = _sliced_changes(spark, sf, "event_type", folder, late)
    return changelog.latest_counts(changes).where(F.col("count") > 0)


def stream_segment_counts(spark, sf):
    """Mentions per quarter of an hour, of a stream in which they come up to 40 minutes late."""
    folder = storage.fresh_dir(spark, "segments")
    events = tables.events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    late = times.whole_seconds("ts") + F.pmod("event_id", F.lit(5)) * 600
    configure(spark, streaming=True)

    def start(source: DataFrame) -> DataStreamWriter:
        counts = cadence.segment_counts(tables.event_mentions(source))
        return lifecycle.file_writer(counts, f"{folder}/counts", f"{folder}/counts-state")

    _in_slices(events, folder, late, start)
    return spark.read.schema("segment string, name string, count long").parquet(f"{folder}/counts")


BACKLOG, AT_ONCE = 7, 2


def stream_limited_batches(spark, sf):
    """Rows of each batch of a stream that takes two files at a time from a backlog of seven."""
    folder = storage.fresh_dir(spark, "limited")
    events = tables.events(spark, sf).select("event_id", "user_id")
    part = F.pmod("user_id", F.lit(BACKLOG)).cast("int")
    streams.write_slices(events, f"{folder}/in", part, BACKLOG)
    options = streams.file_options(AT_ONCE)
    source = spark.readStream.schema(events.schema).options(**options).parquet(f"{folder}/in")

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("rows"))
        storage.publish(counted.select(F.lit(batch_id).alias("batch_id"), "rows"), f"{folder}/out", batch_id)

    lifecycle.run_available(
        source.writeStream.option("checkpointLocation", f"{folder}/state").foreachBatch(write)
    )
    return storage.read_versions(spark, f"{folder}/out", "batch_id int, rows long")


TRIGGERS = 5


def _paced() -> list[int]:
    """The batch of each of BACKLOG versions, TRIGGERS seconds before the next are due."""
    left, batches = BACKLOG, []
    for k in range(TRIGGERS):
        taken = -(-left // (TRIGGERS - k))
        batches += [k] * taken
        left -= taken
    return batches


def stream_paced_backlog(spark, sf):
    """Rows of each batch of a stream that spreads a backlog over the time that is left."""
    folder = storage.fresh_dir(spark, "paced")
    events = tables.events(spark, sf).select("event_id", "user_id")
    part = F.pmod("user_id", F.lit(BACKLOG)).cast("int")
    storage.publish_slices(events, f"{folder}/in", part, BACKLOG, lambda: None)
    source = published.paced_stream(
        spark, f"{folder}/in", events.schema, f"{folder}/pace", interval=TRIGGERS, clock=0
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("rows"))
        storage.publish(counted.select(F.lit(batch_id).alias("batch_id"), "rows"), f"{folder}/out", batch_id)

    query = source.writeStream.option("checkpointLocation", f"{folder}/state").foreachBatch(write).start()
    try:
        query.processAllAvailable()
    finally:
        lifecycle.stop(query)
    return storage.read_versions(spark, f"{folder}/out", "batch_id int, rows long")


LATE_AFTER = 600


def stream_late_mentions(spark, sf):
    """Rows of each batch, and those a watermark of ten minutes drops: they come up to 40 minutes late."""
    folder = storage.fresh_dir(spark, "reports")
    events = tables.events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    late = times.whole_seconds("ts") + F.pmod("event_id", F.lit(5)) * 600

    def start(source: DataFrame) -> DataStreamWriter:
        mentions = tables.event_mentions(source)
        return progress.reports(mentions, f"{folder}/reports", f"{folder}/state", LATE_AFTER)

    _in_slices(events, folder, late, start)
    return progress.read_reports(spark, f"{folder}/reports")


def stream_restarted_counts(spark, sf):
    """Events per type from a stream that ends and starts again, on one checkpoint, after each slice."""
    folder = storage.fresh_dir(spark, "restarted")
    events = tables.events(spark, sf).select("event_id", "ts", "event_type")

    def run() -> None:
        source = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        lifecycle.run_available(lifecycle.file_writer(source, f"{folder}/out", f"{folder}/state"))

    in_order = times.whole_seconds("ts")
    streams.write_slices(events, f"{folder}/in", _slice_of(in_order), len(SLICES) + 1, run)
    seen = spark.read.schema(events.schema).parquet(f"{folder}/out")
    return seen.groupBy(F.col("event_type").alias("name")).agg(
        F.count(F.lit(1)).alias("count"), F.countDistinct("event_id").alias("events")
    )


def stream_topk_snapshot(spark, sf):
    folder = storage.fresh_dir(spark, "topk")
    _stream_changes(spark, sf, "user_id", folder)
    changes = streams.change_stream(spark, f"{folder}/changes")
    lifecycle.run_available(
        topk.live_top_k(changes, f"{folder}/topk", f"{folder}/topk-state", K)
    )
    return topk.read_snapshot(spark, f"{folder}/topk")[1]


def _live_slices(spark: SparkSession, sf: str) -> str:
    """Snapshots and deltas of a stream of changes in slices; the folder they are in."""
    folder = storage.fresh_dir(spark, "topk")
    changes = rolling.rolling_changes(_users(spark, sf))

    def start(source: DataFrame) -> DataStreamWriter:
        return topk.live_top_k(source, f"{folder}/topk", f"{folder}/topk-state", K)

    configure(spark, streaming=True)
    _in_slices(changes, folder, F.col("event_sec"), start)
    return f"{folder}/topk"


def stream_topk_deltas(spark, sf):
    """What changed in the live top K with each slice; a name that left has count 0."""
    return topk.read_deltas(spark, _live_slices(spark, sf))


def stream_topk_replay(spark, sf):
    """The second snapshot and the deltas after it, up to the slice before the last."""
    root = _live_slices(spark, sf)
    at, snapshot = topk.read_snapshot(spark, root, batch_id=1)
    later = topk.read_deltas(spark, root, after=at).where(F.col("batch_id") < len(SLICES))
    start = snapshot.select(F.lit(at).cast("bigint").alias("batch_id"), "name", "count")
    return changelog.materialise(start.unionByName(later), "batch_id")


def stream_coalesced_updates(spark, sf):
    """The newest count of each name and day, of changes that come in slices."""
    folder = storage.fresh_dir(spark, "coalesced")
    changes = rolling.rolling_changes(_types(spark, sf))

    def write(batch: DataFrame, batch_id: int) -> None:
        storage.publish(batch, f"{folder}/out", batch_id)

    def start(source: DataFrame) -> DataStreamWriter:
        latest = changelog.coalesced_updates(source, 86_400)
        return (
            latest.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/state")
            .foreachBatch(write)
        )

    configure(spark, streaming=True)
    _in_slices(changes, folder, F.col("event_sec"), start)
    versions = [storage.version_path(f"{folder}/out", v) for v in storage.versions(spark, f"{folder}/out")]
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/b(\d+)/[^/]*$", 1).cast("bigint")
    updates = spark.read.parquet(*versions).withColumn("batch_id", number)
    return updates.groupBy("flush_sec", "name").agg(F.max_by("count", "batch_id").alias("count"))


def user_type_maps(spark, sf):
    """Counts per user and event type, from two maps per user that are merged."""
    later = (F.col("ts") >= AS_OF).cast("int").alias("later")
    counts = tables.events(spark, sf).groupBy("user_id", later, "event_type").count()
    maps = counts.groupBy("user_id", "later").agg(  # as many entries as there are types
        F.map_from_entries(F.collect_list(F.struct("event_type", "count"))).alias("m")
    )
    both = maps.groupBy("user_id").pivot("later", [0, 1]).agg(F.first("m"))
    none = F.create_map().cast("map<string,bigint>")
    merged = text.merge_count_maps(F.coalesce("0", none), F.coalesce("1", none))
    return both.select("user_id", F.explode(merged).alias("name", "count"))


def record_files_round_trip(spark, sf):
    """Record lines written as files and read again by position and as typed columns."""
    folder = storage.fresh_dir(spark, "records")
    _lines(spark, sf).select("value").write.text(folder)
    by_position = records.line_view(records.read_lines(spark, folder, clean=False))
    typed = records.record_view(records.read_records(spark, folder))
    counts = [
        daily.daily_counts(daily_plans.record_mentions(view)).withColumn("how", F.lit(how))
        for how, view in (("position", by_position), ("typed", typed))
    ]
    return counts[0].unionByName(counts[1]).select("how", "day", "name", "count")


def keyed_line_messages(spark, sf):
    """Record lines as topic rows, and back to their event times."""
    sent = stream_sinks.record_messages(_lines(spark, sf), partition=0)
    back = sent.withColumn("timestamp", F.lit(None).cast("timestamp"))
    return back.select(
        "key", "partition", F.unix_millis(streams.event_time(back)).alias("event_ms")
    )


def malformed_line_names(spark, sf):
    """Names of lines with a byte that is no text before every comma, read in two ways."""
    spaced = F.regexp_replace(F.hex("value"), "(..)", "$1 ")
    broken = F.replace(F.replace(spaced, F.lit("2C "), F.lit("FF 2C ")), F.lit(" "), F.lit(""))
    lines = _lines(spark, sf).select(F.unhex(broken).cast("string").alias("value"))
    cleaned = lines.select(text.drop_malformed_utf8("value").alias("value"))
    found = [
        daily.daily_counts(daily_plans.record_mentions(records.line_view(read))).withColumn(
            "way", F.lit(way)
        )
        for way, read in (("cleaned", cleaned), ("as read", lines))
    ]
    return found[0].unionByName(found[1]).select("way", "day", "name", "count")


QUERIES: tuple[Query, ...] = (
    daily_top_names,
    daily_name_counts,
    daily_name_counts_filtered,
    daily_top_names_one_per_count,
    line_top_names,
    typed_record_top_names,
    line_view_top_names,
    daily_result_lines,
    daily_top_names_refreshed,
    daily_lines_of_paths,
    daily_display_lines,
    daily_counts_keep_empty,
    sorted_name_counts,
    daily_documents,
    ranked_cells,
    record_name_counts,
    record_name_lists,
    result_bounds,
    min_fields_filter,
    clean_text,
    union_segments,
    record_key_parse,
    exact_timestamp,
    sensor_readings,
    segment_names,
    segment_index,
    next_boundary,
    spread_event_times,
    new_segments_only,
    timed_segments,
    last_key,
    newest_event,
    event_bounds,
    rolling_hour_adds,
    rolling_hour_adds_by_user,
    rolling_hour_changelog,
    histogram_as_of,
    histogram_by_tick,
    coalesced_updates,
    topk_snapshot,
    topk_by_tick,
    topk_bounds,
    topk_deltas,
    update_messages,
    parsed_messages,
    materialised_changelog,
    running_increments,
    increment_messages,
    stream_record_mentions,
    stream_published_log,
    stream_rolling_changelog,
    stream_out_of_order_histogram,
    stream_segment_counts,
    stream_limited_batches,
    stream_paced_backlog,
    stream_late_mentions,
    stream_restarted_counts,
    stream_topk_snapshot,
    stream_topk_deltas,
    stream_topk_replay,
    stream_coalesced_updates,
    user_type_maps,
    record_files_round_trip,
    keyed_line_messages,
    malformed_line_names,
)


# --- SQL -----------------------------------------------------------------------------

_NAMES = """names AS (
  SELECT strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS day,
         unnest(regexp_extract_all(text, '\\p{Lu}[\\p{Ll}\\p{M}]+')) AS name
  FROM documents
)"""
_COUNTS = f"""{_NAMES}, counts AS (
  SELECT day, name, count(*) AS "count" FROM names GROUP BY day, name
)"""
_TOP = f"""{_COUNTS}, ranked AS (
  SELECT day, row_number() OVER (PARTITION BY day ORDER BY "count" DESC, name) AS "rank",
         name, "count" FROM counts
), top AS (SELECT * FROM ranked WHERE "rank" <= 10)"""
_TOP_ONE = f"""{_COUNTS}, single AS (
  SELECT day, "count", min(name) AS name FROM counts GROUP BY day, "count"
), ranked AS (
  SELECT day, row_number() OVER (PARTITION BY day ORDER BY "count" DESC) AS "rank",
         name, "count" FROM single
), top AS (SELECT * FROM ranked WHERE "rank" <= 10)"""
_DAY_FIRST = "substr(day, 9, 2) || '-' || substr(day, 6, 2) || '-' || substr(day, 1, 4)"
_SEC = "CAST(floor(epoch(ts)) AS BIGINT)"
_QUARTER = "time_bucket(INTERVAL 15 MINUTE, ts)"


def _adds(name: str) -> str:
    return f"""WITH m AS (
      SELECT event_id, CAST({name} AS VARCHAR) AS name, {_SEC} AS s FROM events
    ) SELECT event_id, name, s AS event_sec,
        CAST(count(*) OVER (PARTITION BY name ORDER BY s
               RANGE BETWEEN 3599 PRECEDING AND 1 PRECEDING)
           + row_number() OVER (PARTITION BY name, s ORDER BY event_id) AS BIGINT) AS "count"
      FROM m"""


_CHANGES = f"""m AS (
  SELECT event_id, event_type AS name, {_SEC} AS s, 1 AS isadd FROM events
), steps AS (
  SELECT * FROM m
  UNION ALL SELECT DISTINCT -1, name, s + 3600, 0 FROM m
), changes AS (
  SELECT name, s AS event_sec, event_id, isadd,
         CASE WHEN isadd = 1 THEN 'add' ELSE 'expire' END AS op,
         CAST(coalesce(sum(isadd) OVER (PARTITION BY name ORDER BY s
                RANGE BETWEEN 3599 PRECEDING AND 1 PRECEDING), 0)
            + sum(isadd) OVER (PARTITION BY name, s ORDER BY isadd, event_id
                ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "count"
  FROM steps
)"""


# The live top K after each slice of changes; by the end of the last, all have expired.
_SLICED = f"""m AS (SELECT CAST(user_id AS VARCHAR) AS name, {_SEC} AS s FROM events),
ends AS (SELECT unnest(range({len(SLICES)})) AS batch_id, unnest({sorted(SLICES)}) AS ends_at),
live AS (
  SELECT batch_id, name, count(*) AS "count" FROM m, ends
  WHERE s <= ends_at AND s > ends_at - 3600 GROUP BY ALL
), tops AS (
  SELECT batch_id, name, "count" FROM live
  QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY "count" DESC, name) <= {K}
)"""


def _ticks(name: str) -> str:
    return f"""m AS (SELECT CAST({name} AS VARCHAR) AS name, {_SEC} AS s FROM events),
    placed AS (
      SELECT name, CAST(ceil(s / 900.0) AS BIGINT) * 900 AS t0 FROM m
    ), live AS (
      SELECT t0 + d AS tick, name, count(*) AS "count"
      FROM placed, (VALUES (0), (900), (1800), (2700)) AS later(d) GROUP BY ALL
    )"""


_TOP_TICKS = f"""{_ticks("user_id")}, topk AS (
  SELECT tick, name, "count", "rank" FROM (
    SELECT *, row_number() OVER (PARTITION BY tick ORDER BY "count" DESC, name) AS "rank"
    FROM live) WHERE "rank" <= {K}
)"""
_DELTAS = f"""{_TOP_TICKS}, deltas AS (
  SELECT coalesce(n.tick, o.tick + 900) AS tick, coalesce(n.name, o.name) AS name,
         coalesce(n."count", 0) AS "count"
  FROM topk AS n FULL OUTER JOIN topk AS o ON n.name = o.name AND n.tick = o.tick + 900
  WHERE n."count" IS DISTINCT FROM o."count"
)"""
_AS_OF_SEC = f"s > {AS_OF_TICK} - 3600 AND s <= {AS_OF_TICK}"

_RESULT_LINES = f"""WITH {_TOP_ONE}
    SELECT 'DateResult(' || {_DAY_FIRST} || ',List('
        || string_agg('(' || name || ',' || "count" || ')', ',' ORDER BY "rank")
        || '))' AS value
    FROM top GROUP BY day"""

ORACLE: dict[str, str] = {
    "daily_top_names": f'WITH {_TOP} SELECT day, "rank", name, "count" FROM top',
    "daily_name_counts": f'WITH {_COUNTS} SELECT day, name, "count" FROM counts',
    "daily_name_counts_filtered": f"""WITH {_COUNTS} SELECT day, name, "count" FROM counts
        WHERE NOT contains(name, 'Th') AND NOT contains(name, 'ie')""",
    "daily_top_names_one_per_count": (
        f'WITH {_TOP_ONE} SELECT day, "rank", name, "count" FROM top'
    ),
    "line_top_names": (
        f'WITH {_TOP_ONE} SELECT {_DAY_FIRST} AS day, "rank", name, "count" FROM top'
    ),
    "typed_record_top_names": f'WITH {_TOP} SELECT day, "rank", name, "count" FROM top',
    "line_view_top_names": f'WITH {_TOP} SELECT day, "rank", name, "count" FROM top',
    "daily_result_lines": _RESULT_LINES,
    "daily_top_names_refreshed": f'WITH {_TOP} SELECT day, "rank", name, "count" FROM top',
    "daily_lines_of_paths": _RESULT_LINES,
    "daily_display_lines": f"""WITH {_TOP}
        SELECT day || ' : ('
            || string_agg('[' || name || ',' || "count" || ']', ', ' ORDER BY "rank")
            || ')' AS value
        FROM top GROUP BY day""",
    "daily_counts_keep_empty": f"""WITH {_NAMES}
        SELECT day, CASE WHEN regexp_matches(name, '[abcdghiklmnoprstuvwz]') THEN ''
                         ELSE name END AS name,
               count(*) FILTER (NOT regexp_matches(name, '[abcdghiklmnoprstuvwz]'))
                 AS "count"
        FROM names GROUP BY 1, 2""",
    "sorted_name_counts": (
        f'WITH {_COUNTS} SELECT day, name, "count" FROM counts ORDER BY 3 DESC, 2, 1'
    ),
    "daily_documents": f"""WITH {_TOP}
        SELECT day AS data, '[' || string_agg(
            '{{"topic":"' || name || '","count":' || "count" || '}}', ','
            ORDER BY "rank") || ']' AS result
        FROM top GROUP BY day""",
    "ranked_cells": (
        f'WITH {_TOP} SELECT day AS "date", "rank" - 1 AS "rank", name AS topic FROM top'
    ),
    "record_name_counts": """WITH found AS (
          SELECT strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y%m%d000000')
                   || '-' || doc_id AS record_id,
                 unnest(regexp_extract_all(text, '\\p{Lu}[\\p{Ll}\\p{M}]+')) AS name
          FROM documents
        ) SELECT record_id, name, count(*) AS "count" FROM found GROUP BY ALL""",
    "record_name_lists": """WITH found AS (
          SELECT strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y%m%d000000')
                   || '-' || doc_id AS record_id,
                 regexp_extract_all(text, '\\p{Lu}[\\p{Ll}\\p{M}]+') AS words
          FROM documents
        ), kept AS (
          SELECT record_id, list_filter(words, lambda w: NOT contains(w, 'Th')) AS names
          FROM found WHERE len(words) > 0
        ) SELECT record_id, array_to_string(names, '|') AS names, len(names) AS n
        FROM kept""",
    "result_bounds": f"""WITH {_COUNTS} SELECT min(day) AS first_day,
        max(day) AS last_day, max("count") AS max_count FROM counts""",
    "min_fields_filter": """SELECT doc_id FROM documents
        WHERE len(string_split(rtrim(text, ' '), ' ')) > 23""",
    "clean_text": "SELECT doc_id, replace(text, chr(65533), '') AS text FROM documents",
    "union_segments": """WITH rows_in AS (
          SELECT 'documents.parquet' AS file_name, text FROM documents
          UNION ALL SELECT 'conversations.parquet', text FROM conversations
          UNION ALL SELECT 'benchmark.parquet', text FROM benchmark
        ), lines_in AS (
          SELECT file_name, unnest(string_split(text, chr(10))) AS line FROM rows_in
        ) SELECT file_name, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars
        FROM lines_in GROUP BY file_name""",
    "record_key_parse": """WITH keyed AS (
          SELECT event_id, CASE event_id % 6
            WHEN 0 THEN event_type || '-' || event_id
            WHEN 1 THEN '1-2-' || event_id
            WHEN 2 THEN event_id || '-'
            WHEN 3 THEN '-' || event_id
            WHEN 4 THEN '7-' || event_id || '--'
            ELSE strftime(ts, '%Y%m%d%H%M%S') || '-' || event_id END AS key
          FROM events
        ), parts AS (
          SELECT event_id, split_part(key, '-', 1) AS head,
                 string_split(rtrim(key, '-'), '-') AS p FROM keyed
        ), numbers AS (
          SELECT event_id, head, len(p) = 2 AND TRY_CAST(p[1] AS BIGINT) IS NOT NULL
                 AND TRY_CAST(p[2] AS BIGINT) IS NOT NULL AS ok,
                 TRY_CAST(p[1] AS BIGINT) AS a, TRY_CAST(p[2] AS BIGINT) AS b FROM parts
        ) SELECT event_id, head, CASE WHEN ok THEN a ELSE 0 END AS "time",
                 CASE WHEN ok THEN b ELSE 0 END AS seq FROM numbers""",
    "exact_timestamp": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderdate = TIMESTAMP '1998-10-03 00:00:00'""",
    "sensor_readings": """SELECT event_type AS sensorname,
          strftime(date_trunc('minute', ts) - CASE WHEN hour(ts) >= 12
            THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S')
            AS "timestamp",
          "value" AS numA, event_id AS numC, user_id AS numE FROM events""",
    "segment_names": f"""WITH listed AS (
          SELECT {_QUARTER} - to_minutes(CAST(b AS INTEGER)) AS t
          FROM events, (VALUES (15), (30), (45), (60)) AS back(b)
        ) SELECT strftime(t, '%Y%m%d%H%M00') || '.gkg.csv' AS file_name,
                 count(*) AS listings FROM listed GROUP BY t""",
    "segment_index": """SELECT 'files:/' || regexp_extract(url, '/[a-z]+/[0-9]+')
            AS location,
          regexp_extract(regexp_extract(url, '/[a-z]+/[0-9]+'), '[0-9]+') AS file_name
        FROM (SELECT url FROM pages ORDER BY page_id LIMIT 100)
        WHERE regexp_extract(url, '/[a-z]+/[0-9]+') <> ''""",
    "next_boundary": f"""SELECT event_id,
          strftime({_QUARTER}, '%Y-%m-%d %H:%M:%S') AS quarter,
          strftime({_QUARTER} + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS next_quarter,
          {_SEC} AS secs FROM events""",
    "spread_event_times": f"""WITH lines_in AS (
          SELECT event_id, {_QUARTER} AS q FROM events
        ), placed AS (
          SELECT event_id, q,
                 row_number() OVER (PARTITION BY q ORDER BY event_id) - 1 AS position,
                 count(*) OVER (PARTITION BY q) AS total FROM lines_in
        ) SELECT event_id, strftime(q, '%Y%m%d%H%M00') AS segment, position, total,
                 epoch_ms(q) + (position * 900000) // total AS event_ms FROM placed""",
    "new_segments_only": f"""SELECT strftime({_QUARTER}, '%Y%m%d%H%M00') AS segment,
          count(*) AS lines FROM events
        WHERE strftime({_QUARTER}, '%Y%m%d%H%M00') > '20240110120000' GROUP BY 1""",
    "last_key": f"""SELECT arg_max(strftime({_QUARTER}, '%Y%m%d%H%M00') || '-' || event_id,
          event_id) AS last_key FROM events""",
    "newest_event": """SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
        FROM events WHERE event_id = (SELECT max(event_id) FROM events)""",
    "timed_segments": f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day, count(*) AS lines,
          CAST(sum(event_id) AS BIGINT) AS ids FROM events
        WHERE date_trunc('day', ts) >= TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY
          AND date_trunc('day', ts) < TIMESTAMP '{AS_OF}' GROUP BY 1""",
    "event_bounds": """SELECT event_id, event_id = n.last AS is_last, events FROM events,
          (SELECT min(event_id) AS first, max(event_id) AS last, count(*) AS events FROM events) n
        WHERE event_id IN (n.first, n.last)""",
    "rolling_hour_adds": _adds("event_type"),
    "rolling_hour_adds_by_user": _adds("user_id"),
    "rolling_hour_changelog": (
        f'WITH {_CHANGES} SELECT name, event_sec, op, "count" FROM changes'
    ),
    "histogram_as_of": f"""SELECT name, count(*) AS "count" FROM (
          SELECT event_type AS name, {_SEC} AS s FROM events) WHERE {_AS_OF_SEC}
        GROUP BY name""",
    "histogram_by_tick": (
        f'WITH {_ticks("event_type")} SELECT tick, name, "count" FROM live'
    ),
    "coalesced_updates": f"""WITH {_CHANGES}
        SELECT event_sec - event_sec % 60 AS flush_sec, name,
               arg_max("count", event_sec * 1000000000 + isadd * 100000000 + event_id)
                 AS "count"
        FROM changes GROUP BY 1, 2""",
    "topk_snapshot": f"""SELECT name, count(*) AS "count" FROM (
          SELECT CAST(user_id AS VARCHAR) AS name, {_SEC} AS s FROM events)
        WHERE {_AS_OF_SEC} GROUP BY name ORDER BY 2 DESC, 1 LIMIT {K}""",
    "topk_by_tick": f'WITH {_TOP_TICKS} SELECT tick, name, "count", "rank" FROM topk',
    "topk_bounds": f"""WITH {_TOP_TICKS} SELECT tick, count(*) AS entries,
          first(name ORDER BY "count", name) AS min_name, min("count") AS min_count
        FROM topk GROUP BY tick""",
    "topk_deltas": f'WITH {_DELTAS} SELECT tick, name, "count" FROM deltas',
    "update_messages": f"""WITH {_DELTAS} SELECT tick, '[' || string_agg(
          '{{"name":"' || name || '","count":' || "count" || '}}', ',' ORDER BY name)
          || ']' AS message FROM deltas GROUP BY tick""",
    "parsed_messages": f'WITH {_DELTAS} SELECT tick, name, "count" FROM deltas',
    "materialised_changelog": f"""WITH {_TOP_TICKS}
        SELECT name, "count" FROM topk WHERE tick = {AS_OF_TICK}""",
    "running_increments": """SELECT event_type AS name,
          CAST(sum(CAST(floor("value") AS BIGINT)) AS BIGINT) AS "count"
        FROM events GROUP BY 1""",
    "increment_messages": """SELECT event_type AS name,
          CAST(sum(CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT)) AS BIGINT)
            AS "count"
        FROM events GROUP BY 1""",
    "stream_record_mentions": f"""WITH {_NAMES}
        SELECT name, count(*) AS "count" FROM names WHERE NOT contains(name, 'Category')
        GROUP BY name""",
    "stream_published_log": """SELECT
          strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y%m%d000000') || '-' || doc_id AS key,
          CAST(1 AS BIGINT) AS copies,
          CAST(len(regexp_extract_all(text, '\\p{Lu}[\\p{Ll}\\p{M}]+')) AS BIGINT) AS names
        FROM documents""",
    "stream_rolling_changelog": f"""WITH {_CHANGES}
        SELECT name, event_sec, op, "count" FROM changes
        WHERE op = 'add' OR event_sec <= (SELECT max({_SEC}) FROM events)""",
    "stream_out_of_order_histogram": f"""SELECT name, count(*) AS "count" FROM (
          SELECT event_type AS name, {_SEC} AS s FROM events)
        WHERE s > (SELECT max({_SEC}) FROM events) - 3600 GROUP BY name""",
    "stream_segment_counts": f"""SELECT strftime({_QUARTER}, '%Y%m%d%H%M00') AS segment,
          event_type AS name, count(*) AS "count" FROM events
        WHERE epoch_ms({_QUARTER}) + 900000 <= (SELECT epoch_ms(max(ts)) FROM events) - 3600000
        GROUP BY ALL""",
    "stream_limited_batches": f"""SELECT CAST((user_id % {BACKLOG}) // {AT_ONCE} AS INTEGER) AS batch_id,
          count(*) AS rows FROM events GROUP BY 1""",
    "stream_paced_backlog": f"""SELECT CAST({_paced()}[user_id % {BACKLOG} + 1] AS INTEGER) AS batch_id,
          count(*) AS rows FROM events GROUP BY 1""",
    "stream_late_mentions": f"""WITH e AS (
          SELECT {_SEC} AS s, {" + ".join(f"CAST({_SEC} + event_id % 5 * 600 > {end} AS BIGINT)" for end in SLICES)} AS b
          FROM events
        ), n AS (SELECT b, max(s) AS newest FROM e GROUP BY b)
        SELECT b AS batch_id, count(*) AS rows,
          CAST(count(*) FILTER (s <= (SELECT max(newest) FROM n WHERE n.b < e.b) - {LATE_AFTER}) AS BIGINT) AS late,
          max(s) AS newest
        FROM e GROUP BY b""",
    "stream_restarted_counts": """SELECT event_type AS name, count(*) AS "count",
          count(DISTINCT event_id) AS events FROM events GROUP BY 1""",
    "stream_topk_deltas": f"""WITH {_SLICED}
        SELECT coalesce(n.batch_id, o.batch_id + 1) AS batch_id, coalesce(n.name, o.name) AS name,
          CAST(coalesce(n."count", 0) AS BIGINT) AS "count"
        FROM tops n FULL JOIN tops o ON n.batch_id = o.batch_id + 1 AND n.name = o.name
        WHERE n."count" IS DISTINCT FROM o."count"
          AND coalesce(n.batch_id, o.batch_id + 1) <= {len(SLICES)}""",
    "stream_topk_replay": f"""WITH {_SLICED}
        SELECT name, "count" FROM tops WHERE batch_id = {len(SLICES) - 1}""",
    "stream_coalesced_updates": f"""WITH {_CHANGES}
        SELECT flush_sec, name, "count" FROM (
          SELECT event_sec - event_sec % 86400 AS flush_sec, name, "count", row_number() OVER (
            PARTITION BY name, event_sec - event_sec % 86400
            ORDER BY event_sec DESC, isadd DESC, event_id DESC) AS r FROM changes) WHERE r = 1""",
    "user_type_maps": """SELECT user_id, event_type AS name, count(*) AS "count"
        FROM events GROUP BY ALL""",
    "record_files_round_trip": f"""WITH {_COUNTS}
        SELECT how, day, name, "count" FROM counts, (VALUES ('position'), ('typed')) w(how)""",
    "keyed_line_messages": """SELECT strftime(day, '%Y%m%d%H%M%S') || '-' || doc_id AS key,
          CAST(0 AS INTEGER) AS partition, epoch_ms(day) AS event_ms
        FROM (SELECT doc_id, CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP) AS day
              FROM documents)""",
    "malformed_line_names": f"""WITH {_COUNTS}
        SELECT way, day, name, "count" FROM counts, (VALUES ('cleaned'), ('as read')) w(way)""",
    "stream_topk_snapshot": f"""SELECT name, count(*) AS "count" FROM (
          SELECT CAST(user_id AS VARCHAR) AS name, {_SEC} AS s FROM events)
        WHERE s > (SELECT max({_SEC}) FROM events) - 3600
        GROUP BY name ORDER BY 2 DESC, 1 LIMIT {K}""",
}


# --- driver contract -------------------------------------------------------------------


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark, input_bytes=bytes_below(spark, sf_dir)), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """The ten names mentioned most on each day."""
    return _configured(daily_top_names)(spark, SMOKE_DIR)


def _llm():
    """The module of training-data queries and the pipeline's, or None where they are left out."""
    try:
        import corpus_pipeline
        from namepulse.llm import registry
    except ImportError:
        return None
    return registry, corpus_pipeline


def queries() -> dict[str, Query]:
    found = list(QUERIES)
    if llm := _llm():
        found += [*llm[0].QUERIES, llm[1].pipeline]
    return {q.__name__: _configured(q) for q in found}


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLE)
    if llm := _llm():
        found |= llm[0].ORACLE
        if llm[1].ORACLE_SQL:
            found["pipeline"] = llm[1].ORACLE_SQL
    return found

"""Every query against its SQL on the given tables."""

import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from namepulse.sources import tables
from oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [q.__name__ for q in entry.QUERIES])
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["day", "rank", "name", "count"]
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert {q.__name__ for q in entry.QUERIES} == set(entry.ORACLE)


def test_batches_of_a_rolling_count_are_bounded(spark, tmp_path, monkeypatch):
    """A task holds what a name has in one batch: all events come after the last of SLICES."""
    r = random.Random(8)
    begin = max(entry.SLICES) + 86_400
    secs = [begin + r.randrange(400_000) for _ in range(3000)] + [begin + 399_000] * 40
    kinds = ["a", "a", "a", "b"]
    rows = [(i, datetime.fromtimestamp(s, timezone.utc), i, kinds[s % 4], 0.0, "{}") for i, s in enumerate(secs)]
    rows += [(len(rows), None, 1, "a", 0.0, "{}")]
    spark.createDataFrame(rows, tables.EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(entry, "SLICE_ROWS", 300, raising=False)
    monkeypatch.setattr(entry.storage, "fresh_dir", lambda spark, name: f"file://{tmp_path}/{name}")

    newest, live = max(secs), {}
    for s in secs:
        if s > newest - 3600:
            live[kinds[s % 4]] = live.get(kinds[s % 4], 0) + 1
    got = entry.stream_out_of_order_histogram(spark, str(tmp_path))
    assert {x["name"]: x["count"] for x in got.collect()} == live

    changes = [(kinds[s % 4], s, "add") for s in secs]  # all mentions of a second expire as one
    changes += [(kinds[s % 4], s + 3600, "expire") for s in {*secs} if s + 3600 <= newest]
    got = entry.stream_rolling_changelog(spark, str(tmp_path))
    assert sorted((x["name"], x["event_sec"], x["op"]) for x in got.collect()) == sorted(changes)

    for name in ("late", "rolling"):
        root = f"{tmp_path}/{name}/in"
        sizes = [spark.read.parquet(f"{root}/{v}").count() for v in sorted(os.listdir(root)) if v.startswith("b")]
        assert sum(sizes) == len(secs) and max(sizes) <= 300 + 40


def test_few_rows_come_in_the_given_slices(spark):
    assert entry._bounded_ends(spark.range(100), F.col("id")) == sorted(entry.SLICES)

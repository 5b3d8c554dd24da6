"""What the stateful processors read and write, with a state store that counts."""

import os
import random
import tracemalloc
from pathlib import Path

import pytest

from namepulse import schemas
from namepulse.operators import changelog
from namepulse.streaming import lifecycle, published, state, storage, topk
from namepulse.streaming import rolling as stream_rolling


class Map:
    """A map of state; counts its reads and the numbers written."""

    def __init__(self):
        self.held, self.reads, self.written = {}, 0, 0

    def getValue(self, key):
        self.reads += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.written += sum(len(v) if isinstance(v, list) else 1 for v in value)
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]

    def iterator(self):
        self.reads += len(self.held)
        return iter(list(self.held.items()))


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, *_):
        return Value()

    def getMapState(self, *_):
        return Map()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def rolling(window=3600, delay=4500):
    processor = state.RollingCount(window, delay)
    processor.init(Handle())
    return processor


def advance(processor, added, newest=0, fired=False):
    return [tuple(r)[1:] for r in processor._advance("a", added, newest, fired)]


def test_one_mention_costs_the_same_however_many_seconds_live():
    costs = []
    for live in (1, 60, 600, 3599):
        processor = rolling()
        advance(processor, {s: 1 for s in range(10_000, 10_000 + live)})
        processor.blocks.written = processor.blocks.reads = 0
        changes = advance(processor, {10_000 + live: 1})
        assert changes[-1][3] == live + 1
        costs.append(processor.blocks.written)
        assert processor.blocks.reads <= 2
    assert max(costs) <= 2 * processor.width


@pytest.mark.parametrize("window", [1, 7, 60, 100, 3600])
def test_live_seconds_equal_a_plain_count(window):
    """Batches of any size, mentions in any order, and the state between them."""
    r = random.Random(window)
    processor, live, latest, total = rolling(window), {}, None, 0
    for _ in range(120):
        base = (latest or 50_000) + r.randrange(-window, window)
        added = {max(base + r.randrange(-window, 2 * window), 1): r.randint(1, 3) for _ in range(r.randint(1, 8))}
        changes = advance(processor, added)
        total += sum(c[3] - c[2] for c in changes)
        for sec in sorted(added):
            latest = sec if latest is None else max(latest, sec)
            live = {s: n for s, n in live.items() if s > latest - window}
            if sec > latest - window:
                live[sec] = live.get(sec, 0) + added[sec]
        assert total == sum(live.values()) == changes[-1][3]
        assert [c[2] for c in changes[1:]] == [c[3] for c in changes[:-1]]
        stored = {s: n for secs, counts in processor.blocks.held.values() for s, n in zip(secs, counts)}
        assert stored == live and processor.head.held[3] == min(live)
        assert len(processor.handle.timers) == 1
    ended = advance(processor, {}, latest + 2 * window, fired=True)
    assert ended[-1][3] == 0 and not processor.blocks.held and processor.head.held is None


def test_state_leaves_in_two_steps():
    processor = rolling()
    advance(processor, {10_000: 2})
    assert advance(processor, {}, 13_600, fired=True) == [(13_600, "expire", 2, 0, 2)]
    assert processor.head.held is not None and not processor.blocks.held
    assert advance(processor, {}, 17_200, fired=True) == [] and processor.head.held is None


class Clock:
    def getCurrentWatermarkInMs(self):
        return 0


def plain(row):
    """The changes of a run, as `streaming.rolling.changes_of` gives them."""
    counts = [row["before"], *(row["before"] + c for c in row["counts"].tolist()), row["after"]]
    secs = (row["sec"] + s for s in row["secs"].tolist())
    return [(s, *counts[i : i + 2], row["seq"] + i) for i, s in enumerate(secs)]


def test_a_batch_of_one_name_is_held_as_short_numbers():
    """All rows of a name are held at once, so what a mention takes there bounds a task's memory."""
    mentions = 60_000
    processor = rolling()
    buckets = ((("a", 1_000_000 + 9 * (i * 7919 % mentions), 1 + i % 3, None)) for i in range(mentions))
    tracemalloc.start()
    held = [row.asDict(True) for row in processor.handleInputRows(("a",), buckets, Clock())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * mentions
    added = {1_000_000 + 9 * (i * 7919 % mentions): 1 + i % 3 for i in range(mentions)}
    want = [(c[0], *c[2:]) for c in advance(rolling(), added, newest=processor.delay)]
    assert [c for row in held for c in plain(row)] == want and len(want) > 1.9 * mentions


def test_a_batch_holds_the_blocks_that_are_live():
    blocks = state.LiveSeconds(Map(), 60)
    for sec in range(0, 600_000, 30):
        while blocks.oldest is not None and blocks.oldest <= sec - 3600:
            blocks.pop_oldest()
        blocks.add(sec, 1)
    assert len(blocks.read) <= 62 and len(blocks.touched) <= 62


def test_a_block_that_emptied_begins_anew():
    processor = rolling(window=600)
    advance(processor, {600: 1, 601: 2})
    changes = advance(processor, {609: 1, 1205: 5, 1300: 1})
    assert [c[3] for c in changes] == [4, 3, 1, 6, 5, 6]
    stored = {s: n for secs, counts in processor.blocks.held.values() for s, n in zip(secs, counts)}
    assert stored == {1205: 5, 1300: 1}


def test_buckets_come_in_order_and_added_up(monkeypatch):
    monkeypatch.setattr(state, "WAITING", 50)
    monkeypatch.setattr(state, "RUN_CHANGES", 7)
    r = random.Random(1)
    rows = [("a", r.randrange(-300, 300), r.choice([1, 2, 400_000, 600_000, 3_000_000]), None) for _ in range(2000)]
    rows += [("a", 9_223_372_036_854, 1, None), ("a", -9_223_372_036_855, 2, None)]
    want = {}
    for _, sec, n, _ in rows:
        want[sec] = want.get(sec, 0) + n
    assert list(state.in_time_order(iter(rows))) == sorted(want.items())
    assert list(state.in_time_order(iter([]))) == []


def test_runs_are_read_back_as_changes(spark):
    """Also where seconds or counts of a run lie far apart."""
    far = 1 << 40
    changes = [("a", 5, "add", 0, 2, 10), ("a", 9, "add", 2, far, 11), ("a", far, "expire", far, 3, 12)]
    changes += [("a", far - 7, "add", 3, 4, 13), ("a", far, "expire", 4, 0, 14)]
    given = [tuple(x.tolist() if hasattr(x, "tolist") else x for x in row) for row in state.runs(iter(changes))]
    found = stream_rolling.changes_of(spark.createDataFrame(given, state.RUN_COLUMNS))
    assert found.columns == schemas.COUNT_CHANGES.names
    assert [f.dataType for f in found.schema] == [f.dataType for f in schemas.COUNT_CHANGES]
    assert sorted((tuple(r) for r in found.collect()), key=lambda c: c[5]) == changes


def top(k):
    processor = state.ShardTop(k)
    processor.init(Handle())
    return processor


def feed(processor, rows, first):
    given = [(0, name, count, first + i) for i, (name, count) in enumerate(rows)]
    return [(r["name"], r["count"]) for r in processor.handleInputRows((0,), iter(given), None)]


@pytest.mark.parametrize("k", [1, 2, 5])
def test_shard_top_equals_a_sort(k):
    r = random.Random(k)
    processor, truth, shown, seq, scans = top(k), {}, [], 0, 0
    for _ in range(600):
        rows = [(f"n{r.randrange(60)}", r.choice([0, 0, 1, 2, 3, r.randrange(40)])) for _ in range(r.randint(1, 6))]
        before = processor.counts.reads
        given = feed(processor, rows, seq)
        scans += processor.counts.reads - before > len(rows)
        seq += len(rows)
        truth.update(rows)
        want = sorted(((n, c) for n, c in truth.items() if c), key=lambda x: (-x[1], x[0]))[:k]
        if given:
            shown = [x for x in given if x[0] is not None]
        assert shown == want
        assert {n: v[0] for (n,), v in processor.counts.held.items()} == {n: c for n, c in truth.items() if c}
    assert scans < 200


def test_shard_top_of_an_empty_shard_says_so():
    processor = top(2)
    assert feed(processor, [("a", 3)], 0) == [("a", 3)]
    assert feed(processor, [("a", 0)], 1) == [(None, 0)]
    assert feed(processor, [("b", 0)], 2) == []


def test_older_changes_do_not_undo_newer_ones():
    processor = top(2)
    assert feed(processor, [("a", 3)], 9) == [("a", 3)]
    assert feed(processor, [("a", 7)], 4) == []


def bytes_below(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*") if f.is_file())


def test_a_batch_writes_what_it_changes(spark):
    """3,000 names live; a batch that changes one of them writes a small part of the first one's bytes."""
    folder = storage.fresh_dir(spark, "top")
    local = folder.removeprefix("file:")
    schema = schemas.COUNT_CHANGES
    query = topk.live_top_k(published.stream(spark, f"{folder}/in", schema), f"{folder}/top", f"{folder}/state", 5)

    def publish(k, rows):
        data = [(n, i, "add", c - 1, c, 10_000 * k + i) for i, (n, c) in enumerate(rows)]
        storage.publish(spark.createDataFrame(data, schema), f"{folder}/in", k)
        before = bytes_below(f"{local}/top") + bytes_below(f"{local}/state")
        running.processAllAvailable()
        return bytes_below(f"{local}/top") + bytes_below(f"{local}/state") - before

    os.makedirs(f"{local}/in")
    running = query.start()
    running.processAllAvailable()
    many = publish(0, [(f"a name of some length {i}", i % 50 + 1) for i in range(3000)])
    one = publish(1, [("a name of some length 7", 900)])
    lifecycle.stop(running)
    held = topk.read_snapshot(spark, f"{folder}/top")[1].collect()
    assert sorted((-r["count"], r["name"]) for r in held)[0] == (-900, "a name of some length 7") and len(held) == 5
    assert one < many / 4
    replayed = changelog.materialise(topk.read_deltas(spark, f"{folder}/top"), "batch_id")
    assert {tuple(r) for r in replayed.select("name", "count").collect()} == {tuple(r) for r in held}

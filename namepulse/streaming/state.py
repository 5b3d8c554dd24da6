"""Python code that runs inside tasks: the per-name state and the pre-aggregation before it.

This module imports nothing from the package and is pickled by value, so that executors
need no copy of the package.
"""

from __future__ import annotations

import heapq
import sys
from array import array
from bisect import insort
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = Row("name", "seq", "sec", "before", "after", "secs", "counts")
RUN_COLUMNS = (
    "name string, seq long, sec long, before long, after long, secs array<int>, counts array<int>"
)
TOP = Row("shard", "name", "count")
BUCKET_COLUMNS = "name string, sec long, n long, timestamp timestamp"

# Changes of a name that one row holds.
RUN_CHANGES = 1 << 12

# A name's buckets that wait to be added up with those that came before, at least.
WAITING = 1 << 16

# Bits of a packed bucket that hold mentions; the others hold any second of a timestamp.
MENTION_BITS = 19
MENTIONS = (1 << MENTION_BITS) - 1

# Changes of a name in one second that leave its seq ahead of what came before.
SEQ_PER_SECOND = 1 << 20


def combine_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up mentions per (name, second) inside each batch, ahead of the shuffle.

    `timestamp` is the whole second, so that what is late does not depend on the batch.
    """
    for batch in batches:
        if batch.num_rows:
            summed = (
                pa.Table.from_batches([batch])
                .group_by(["name", "sec"])
                .aggregate([("n", "sum"), ("timestamp", "max")])
                .select(["name", "sec", "n_sum", "timestamp_max"])
                .rename_columns(["name", "sec", "n", "timestamp"])
            )
            yield from summed.to_batches()


def in_time_order(rows: Iterable[Row]) -> Iterator[tuple[int, int]]:
    """(second, mentions) of a name's buckets, each second once.

    A bucket is kept as one number, for a batch may hold all that a name has ever had.
    """
    packed, limit = array("q"), WAITING
    for row in rows:
        sec, n = row[1], row[2]
        while n > 0:
            part = min(n, MENTIONS)
            packed.append(sec << MENTION_BITS | part)
            n -= part
        if len(packed) >= limit:
            packed = _merged(packed)
            limit = len(packed) + max(len(packed) // 2, WAITING)
    ordered = np.frombuffer(packed, np.int64)
    ordered.sort()
    for start in range(0, len(ordered), RUN_CHANGES):
        part = ordered[start : start + RUN_CHANGES]
        if not start:
            last, total = int(part[0]) >> MENTION_BITS, 0
        for sec, n in zip((part >> MENTION_BITS).tolist(), (part & MENTIONS).tolist()):
            if sec != last:
                yield last, total
                last, total = sec, 0
            total += n
    if len(ordered):
        yield last, total


def _merged(packed: array) -> array:
    """The same mentions in as few numbers as they need."""
    merged = array("q")
    ordered = np.frombuffer(packed, np.int64)
    ordered.sort()
    for start in range(0, len(ordered), WAITING):
        part = ordered[start : start + WAITING]
        secs = part >> MENTION_BITS
        first = np.flatnonzero(np.diff(secs, prepend=secs[0] - 1))
        sums = np.add.reduceat(part & MENTIONS, first)
        more = (sums - 1) // MENTIONS
        n = np.full(len(sums) + more.sum(), MENTIONS)
        n[np.cumsum(more + 1) - 1] = sums - more * MENTIONS
        merged.frombytes((np.repeat(secs[first], more + 1) << MENTION_BITS | n).tobytes())
    return merged


def runs(changes: Iterator[tuple]) -> Iterator[Row]:
    """Changes of one call of `RollingCount._advance`, as few rows of short numbers.

    Spark holds all rows of a name until its batch is through. In a run the seq rises by one
    from `seq`, `secs` count from `sec` and `counts` from `before`, the count before the first
    change; they give the count after each change but the last, which is `after`.
    """
    while part := list(islice(changes, RUN_CHANGES)):
        yield from _runs(part)


def _runs(part: list[tuple]) -> Iterator[Row]:
    name, sec, _, before, _, seq = part[0]
    secs = np.array([c[1] for c in part], np.int64) - sec
    counts = np.array([c[4] for c in part[:-1]], np.int64) - before
    if len(part) > 1 and max(np.abs(secs).max(), np.abs(counts).max()) > np.iinfo(np.int32).max:
        half = len(part) // 2
        yield from _runs(part[:half])
        yield from _runs(part[half:])
    else:
        yield RUN(name, seq, sec, before, part[-1][4], secs.astype(np.int32), counts.astype(np.int32))


class RollingCount(StatefulProcessor):
    """Count of a name's mentions in the last `window` seconds of event time.

    State is a head of fixed size per name (latest second, last seq, total, oldest live second,
    which blocks are live) and a map of blocks: the live seconds of a sixtieth of the window
    with their mentions. A batch reads and writes the head and the blocks that its mentions and
    expiries touch, so one new mention costs the same however many seconds are live. Seconds
    that have expired by the time of a new mention are dropped with it, before the mention is
    added. One timer per name waits for the oldest second to expire. The watermark is `delay`
    seconds behind the newest mention, so timers are set that much earlier: names that fall
    idle expire with the newest time seen, while late mentions still count.

    A name without live seconds keeps its seq for another `window`, then leaves no state. By
    then a seq that begins with the newest time is larger than any it has had.
    """

    def __init__(self, window: int, delay: int):
        self.window, self.delay = window, delay
        self.width = -(-window // BLOCKS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState(
            "head", "latest long, seq long, total long, oldest long, base long, live long"
        )
        self.blocks = handle.getMapState("blocks", "block long", "secs array<long>, counts array<long>")

    def close(self) -> None:
        pass

    def _newest(self, timerValues) -> int:
        return timerValues.getCurrentWatermarkInMs() // 1000 + self.delay

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return runs(self._advance(key[0], in_time_order(rows), self._newest(timerValues)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return runs(self._advance(key[0], {}, self._newest(timerValues), fired=True))

    def _advance(
        self,
        name: str,
        added: dict[int, int] | Iterator[tuple[int, int]],
        newest: int,
        fired: bool = False,
    ) -> Iterator[tuple]:
        """Apply new mentions in time order and what expires before them.

        `added`: mentions by second, or (second, mentions) in time order. When the timer has
        fired, also what has expired by the newest time. Gives (name, event_sec, op,
        prev_count, count, seq) per change.
        """
        if isinstance(added, dict):
            added = iter(sorted(added.items()))
        seconds = LiveSeconds(self.blocks, self.width)
        head = self.head.get() if self.head.exists() else None
        latest, seq, total = head[:3] if head else (None, newest * SEQ_PER_SECOND, 0)
        if head:
            seconds.begin(*head[3:])
        due = self._due(latest, seconds.oldest)
        changed = False

        def change(sec: int, op: str, delta: int) -> tuple:
            nonlocal total, changed, seq
            total, changed, seq = total + delta, True, seq + 1
            return name, sec, op, total - delta, total, seq

        def expired(now: int) -> Iterator[tuple]:
            while seconds.oldest is not None and seconds.oldest <= now - self.window:
                sec = seconds.oldest
                yield change(sec + self.window, "expire", -seconds.pop_oldest())

        for sec, n in added:
            latest = sec if latest is None else max(latest, sec)
            yield from expired(latest)
            if sec <= latest - self.window:  # it came and went before
                yield change(sec, "add", n)
                yield change(sec + self.window, "expire", -n)
                continue
            seconds.add(sec, n)
            yield change(sec, "add", n)
        if fired:
            yield from expired(newest)

        seconds.save()
        if seconds.oldest is None and fired and newest >= latest + 2 * self.window:
            self.head.clear()
            return
        self._wait(due, self._due(latest, seconds.oldest), fired)
        if changed:
            self.head.update((latest, seq, total, *seconds.end()))

    def _due(self, latest: int | None, oldest: int | None) -> int | None:
        """When the oldest second expires, or the state of a name that has none."""
        if oldest is not None:
            return oldest + self.window
        return None if latest is None else latest + 2 * self.window

    def _wait(self, before: int | None, now: int, fired: bool) -> None:
        """Move the timer."""
        if before == now and not fired:
            return
        if before is not None and not fired:
            self.handle.deleteTimer(self._timer(before))
        self.handle.registerTimer(self._timer(now))

    def _timer(self, due: int) -> int:
        return max(due - self.delay, 1) * 1000


# Blocks of a window; live seconds lie in two more at most, which fit the bits of a long.
BLOCKS = 60


class LiveSeconds:
    """A name's live seconds with their mentions, in blocks of a map that are read when touched."""

    def __init__(self, stored, width: int):
        self.stored, self.width = stored, width
        self.oldest: int | None = None
        self.live: list[int] = []  # numbers of the blocks that hold a second, ascending
        self.known: set[int] = set()  # those that are in the map
        self.read: dict[int, dict[int, int]] = {}
        self.touched: set[int] = set()

    def begin(self, oldest: int | None, base: int, live: int) -> None:
        """Go on from what `end` gave."""
        self.oldest = oldest
        self.live = [base + i for i in range(live.bit_length()) if live >> i & 1]
        self.known = set(self.live)

    def end(self) -> tuple[int | None, int, int]:
        base = self.live[0] if self.live else 0
        return self.oldest, base, sum(1 << (b - base) for b in self.live)

    def _block(self, number: int) -> dict[int, int]:
        if number not in self.read:
            found = self.stored.getValue((number,)) if number in self.known else None
            self.read[number] = dict(zip(found[0], found[1])) if found else {}
        return self.read[number]

    def add(self, sec: int, n: int) -> None:
        number = sec // self.width
        block = self._block(number)
        if not block:
            insort(self.live, number)
        block[sec] = block.get(sec, 0) + n
        self.touched.add(number)
        self.oldest = sec if self.oldest is None else min(self.oldest, sec)

    def pop_oldest(self) -> int:
        """Drop the oldest second; its mentions."""
        number = self.live[0]
        block = self._block(number)
        n = block.pop(self.oldest)
        self.touched.add(number)
        if not block:
            self._drop(number)
        first = self._block(self.live[0]) if self.live else None
        self.oldest = min(first) if first else None
        return n

    def _drop(self, number: int) -> None:
        """Forget the oldest block, which is empty: a batch holds no more blocks than are live."""
        del self.live[0], self.read[number]
        self.touched.remove(number)
        if number in self.known:
            self.known.remove(number)
            self.stored.removeKey((number,))

    def save(self) -> None:
        """Write the blocks that changed."""
        for number in self.touched:
            block = self.read[number]
            secs = sorted(block)
            self.stored.updateValue((number,), (secs, [block[s] for s in secs]))


def newest_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each name the change with the largest seq, inside each batch, ahead of the shuffle."""
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch]).sort_by("seq")
            last = table.group_by(["shard", "name"], use_threads=False).aggregate([("count", "last"), ("seq", "last")])
            yield from last.select(["shard", "name", "count_last", "seq_last"]).rename_columns(
                ["shard", "name", "count", "seq"]
            ).to_batches()


class ShardTop(StatefulProcessor):
    """The `k` largest counts among the names of a shard, given whenever they change.

    State is a map of all live names (count, seq), of which a batch writes those that it
    changes, and a list of the best SPARE * k names with a bound: every name outside of the
    list ranks at the bound or behind it. Names that fall or leave shorten the list; only when
    fewer than k are left is the map looked through again, which so many falls pay for.

    Rows are (shard, name, count); a shard without names gives one row without a name.
    """

    SPARE = 4

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "name string", "count long, seq long")
        self.best = handle.getValueState(
            "best", "names array<string>, counts array<long>, bound_count long, bound_name string"
        )

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest: dict[str, tuple[int, int]] = {}
        for _, name, count, seq in rows:
            if name not in newest or seq > newest[name][1]:
                newest[name] = (count, seq)
        held = self.best.get() if self.best.exists() else None
        ranked = [(-c, n) for n, c in zip(held[0], held[1])] if held else []
        bound = (-held[2], held[3]) if held and held[3] is not None else None
        before = ranked[: self.k]

        best = {n: c for c, n in ranked}
        for name, (count, seq) in newest.items():
            old = self.counts.getValue((name,))
            if old is not None and old[1] >= seq:
                continue
            best.pop(name, None)
            if count > 0:
                self.counts.updateValue((name,), (count, seq))
                if bound is None or (-count, name) < bound:
                    best[name] = -count
            elif old is not None:
                self.counts.removeKey((name,))
        ranked = sorted((c, n) for n, c in best.items())
        if len(ranked) < self.k and bound is not None:
            everyone = ((-value[0], name[0]) for name, value in self.counts.iterator())
            ranked, bound = heapq.nsmallest(self.SPARE * self.k + 1, everyone), None
        if len(ranked) > self.SPARE * self.k:
            bound = ranked[self.SPARE * self.k]
            ranked = ranked[: self.SPARE * self.k]
        names, counts = [n for _, n in ranked], [-c for c, _ in ranked]
        self.best.update((names, counts, *((-bound[0], bound[1]) if bound else (None, None))))

        now = ranked[: self.k]
        if now != before or not held:
            for count, name in now or [(0, None)]:
                yield TOP(key[0], name, -count)

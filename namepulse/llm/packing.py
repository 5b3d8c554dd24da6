"""Packing of token sequences: matching of large items, best fit for small ones.

Only lengths matter for the packing, and there are at most `capacity` of them. So the plan is
made from the number of pieces of each length: items above a third of the capacity are matched
greedily, at most two to a bin (the longest takes the longest partner that fits), then smaller
ones, longest first, go to the fullest bin that has room. The plan is a bounded list of runs: so
many pieces of one length go to consecutive bins. Pieces find their place by their rank among
those of their length, which needs no more than a count per task and length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .shared import hot_join, kept, once, prepared
from .tokens import encoded_runs, encoder

CAPACITY = 2048

# Units that a Python worker remembers: fewer than for token files, as stages of a pipeline
# that follow each other share the workers.
MAX_UNITS = 400_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def _cut(path: str, units: str, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of documents; `nth` counts those of one length within the task."""
        encode, part = encoder(path, units, MAX_UNITS), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            doc_ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            rows = []
            for k, ids, ends in encoded_runs(texts, encode):
                begin = 0
                for j, end in enumerate(ends.tolist()):
                    whole = np.append(ids[begin:end], np.uint32(end_id)).astype("<u4")
                    begin = end
                    for piece, at in enumerate(range(0, len(whole), capacity)):
                        own = whole[at : at + capacity]
                        n = len(own)
                        rows.append(
                            (doc_ids[k + j], piece, at, n, zlib.crc32(own.tobytes()), part, int(seen[n]))
                        )
                        seen[n] += 1
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names
            )

    return cut


def pieces(
    docs: DataFrame,
    vocabulary: str,
    units: str = "words",
    end_id: int = 0,
    capacity: int = CAPACITY,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document's ids and the end id, cut where they exceed the capacity."""
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    prepared(docs.sparkSession)
    return rows.mapInArrow(_cut(vocabulary, units, end_id, capacity), PIECES)


class Run(NamedTuple):
    """Pieces of one length, from rank on, go `per_bin` each to bins from first_bin on."""

    length: int
    rank: int
    first_bin: int
    per_bin: int
    offset: int


class _Bins:
    """Consecutive bins that are filled alike, by the room they have left."""

    def __init__(self):
        self.room: dict[int, list[tuple[int, int]]] = {}  # room -> [(first bin, bins)]
        self.rooms: list[int] = []

    def put(self, room: int, first: int, bins: int) -> None:
        if bins and room:
            if room not in self.room:
                self.room[room] = []
                insort(self.rooms, room)
            self.room[room].append((first, bins))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """(room, first bin, bins) with the smallest sufficient room."""
        k = bisect_left(self.rooms, least)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        first, bins = self.room[room].pop()
        if not self.room[room]:
            del self.room[room]
            del self.rooms[k]
        return room, first, bins


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place `counts[length]` pieces of each length from 1 to capacity."""
    runs: list[Run] = []
    bins, next_bin = _Bins(), 0
    left = {n: c for n, c in counts.items() if c}
    ranks = dict.fromkeys(left, 0)

    def place(length: int, n: int, first: int, per_bin: int, offset: int) -> None:
        runs.append(Run(length, ranks[length], first, per_bin, offset))
        ranks[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    # Large items: more than a third of a bin, so two at most fit together.
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        k = bisect_left(large, capacity - longest + 1) - 1  # the longest that fits beside it
        partner = large[k] if k >= 0 else None
        if partner == longest and left[longest] == 1:
            partner = large[k - 1] if k > 0 else None
        if partner is None:
            n, used = left[longest], longest
            place(longest, n, next_bin, 1, 0)
        elif partner == longest:
            n, used = left[longest] // 2, 2 * longest
            place(longest, 2 * n, next_bin, 2, 0)
        else:
            n, used = min(left[longest], left[partner]), longest + partner
            place(longest, n, next_bin, 1, 0)
            place(partner, n, next_bin, 1, longest)
        bins.put(capacity - used, next_bin, n)
        next_bin += n
        large = [x for x in large if x in left]

    for length in sorted(left, reverse=True):
        while length in left:
            found = bins.take(length)
            if found is None:
                each = capacity // length
                found = capacity, next_bin, -(-left[length] // each)
                next_bin += found[2]
            room, first, n_bins = found
            each = room // length
            whole = min(n_bins, left[length] // each)
            if whole:
                place(length, whole * each, first, each, capacity - room)
                bins.put(room - each * length, first, whole)
                first, n_bins = first + whole, n_bins - whole
            if n_bins and length in left and left[length] < each:
                rest = left[length]
                place(length, rest, first, rest, capacity - room)
                bins.put(room - rest * length, first, 1)
                first, n_bins = first + 1, n_bins - 1
            bins.put(room, first, n_bins)
    return runs


def _placer(runs: list[Run], capacity: int):
    """A lookup of (length, rank) in the runs, which are at most a few thousand rows."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        n, rank = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lengths, ranks))
        # Runs of a length are contiguous and start at rank 0; ranks stay below 2^50.
        keys = table[:, 0] * (1 << 50) + table[:, 1]
        own = table[np.searchsorted(keys, n * (1 << 50) + rank, side="right") - 1]
        nth = rank - own[:, 1]
        return pa.StructArray.from_arrays(
            [pa.array(own[:, 2] + nth // own[:, 3]), pa.array(own[:, 4] + nth % own[:, 3] * n)],
            ["sequence_id", "offset"],
        )

    return place


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset; no sequence exceeds the capacity.

    cut is read several times, so it should be a written table. No pieces give no rows.
    """
    per_task = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if not counts:
        none = F.lit(None).cast("bigint")
        return cut.select("*", none.alias("sequence_id"), none.alias("offset"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    bases = per_task.select("part", "length", before.alias("base"))
    ranked = hot_join(cut, bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    place = once(_placer(plan(counts, capacity), capacity), "struct<sequence_id:bigint,offset:bigint>")
    return ranked.withColumn("_at", place("length", "rank")).select(*cut.columns, "_at.sequence_id", "_at.offset")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """Documents cut into pieces and packed: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A null text is empty and gives the end id alone. Repeated rows are packed each.
    """
    cut = kept(pieces(docs, vocabulary, capacity=capacity, **options), "pieces")
    return packed(cut, capacity).drop("part", "nth")

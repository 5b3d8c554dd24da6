"""Benchmark decontamination by spaced seeds.

A seed is a mask that looks at some word positions and skips the others, so that a hit survives
words that were replaced at skipped positions. The seeds of the test items are hashed, looked up
in the hashes of every training text, and around each hit the two texts are compared word by
word on the hit's diagonal: a run of words that agree often enough over enough of the item is an
overlap.

The test items are the query set: they are taken in blocks whose seeds and words have a bounded
size, and each block is sent to the tasks that read the documents. No document is shuffled, and
the number of blocks follows from the size of the benchmark alone.

Words are as in the license scans (A to Z in lower case, marks do not count). Items shorter than
a mask are looked up whole; items without words match nothing. A null text counts as empty.
Repeated rows, of documents or items, are each reported.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .licenses import words_of
from .shared import once, text_bytes, unused

# 1: the word counts. No run of 8 words or more with 80 % equal is without a hit: a longer run has
# a part of 8 to 15 words with that share, and for these lengths all places that replaced words
# can take were gone through; in each case one of the masks finds its four equal words.
MASKS = ("11101", "1100101")

# Pairs of equal seeds that are looked at in one go.
PAIRS_AT_ONCE = 1 << 18

# An overlap has at least this share of equal words, over at least this many words, and over
# this share of the item or more than `LONG_RUN` words.
IDENTITY = 0.8
LEAST_WORDS = 8
ITEM_SHARE = 0.5
LONG_RUN = 50

# Most seeds and words of test items in one block: 24 bytes a seed, 8 a word.
BLOCK_WORDS = 500_000

_MIX = np.array([0x9E3779B97F4A7C15 ^ (0x2545F4914F6CDD1D * (i + 1)) & (2**64 - 1) | 1 for i in range(64)], np.uint64)

HIT = "item_id:bigint,first_word:int,n_words:int,n_equal:int,share_of_item:double"


def word_hashes(data: bytes) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words_of(data)), np.uint64)


def seeds(words: np.ndarray, offsets: tuple[int, ...], span: int, salt: int) -> np.ndarray:
    """The hash of a mask at each place where it fits."""
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, salt, np.uint64)
    for k, o in enumerate(offsets):
        mixed = words[o : o + n] * _MIX[k % 64]
        total = (total ^ (mixed >> np.uint64(29)) ^ mixed) * _MIX[(k + 7) % 64]
    return total


def _offsets(mask: str) -> tuple[int, ...]:
    return tuple(i for i, c in enumerate(mask) if c == "1")


@dataclass
class Block:
    """Test items with their seeds, sorted by hash within each mask."""

    item_ids: list[int | None]
    words: list[np.ndarray]
    tables: list[tuple[tuple[int, ...], int, int, np.ndarray, np.ndarray, np.ndarray]]
    identity: float = IDENTITY
    least_words: int = LEAST_WORDS
    item_share: float = ITEM_SHARE
    long_run: int = LONG_RUN

    @classmethod
    def of(cls, items: list[tuple[int | None, bytes]], **options) -> Block:
        words = [word_hashes(text) for _, text in items]
        shortest = min(map(len, MASKS))
        masks = [(_offsets(m), len(m), k) for k, m in enumerate(MASKS)]
        # Whole items that are shorter than every mask.
        masks += [
            (tuple(range(n)), n, 100 + n) for n in sorted({len(w) for w in words if 0 < len(w) < shortest})
        ]
        tables = []
        for offsets, span, salt in masks:
            short = span < shortest
            own = [k for k, w in enumerate(words) if (len(w) == span if short else len(w) >= span)]
            found = [seeds(words[k], offsets, span, salt) for k in own]
            if not found:
                continue
            hashes = np.concatenate(found)
            items_of = np.repeat(own, [len(x) for x in found])
            places = np.concatenate([np.arange(len(x)) for x in found])
            order = np.argsort(hashes, kind="stable")
            tables.append((offsets, span, salt, hashes[order], items_of[order], places[order]))
        return cls([i for i, _ in items], words, tables, **options)

    def _parts(self, words: np.ndarray, done: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(items, places in the text less places in the item) of all hits, a bounded part at a time.

        Hits of an item on diagonals from `done` on are left out, as that changes meanwhile.
        """
        for offsets, span, salt, hashes, items_of, places in self.tables:
            own = seeds(words, offsets, span, salt)
            low = np.searchsorted(hashes, own)
            at = np.flatnonzero(hashes[np.minimum(low, len(hashes) - 1)] == own)
            each = np.searchsorted(hashes, own[at], "right") - low[at]
            ends = np.cumsum(each)
            begin = 0
            while begin < len(at):
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, "right")))
                n = each[begin:end]
                first = np.repeat(low[at[begin:end]] - (ends[begin:end] - n - before), n)
                pairs = first + np.arange(int(n.sum()))
                items, diagonals = items_of[pairs], np.repeat(at[begin:end], n) - places[pairs]
                new = diagonals < done[items]
                yield items[new], diagonals[new]
                begin = end

    def _diagonals(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, diagonal) of all hits."""
        everything = np.full(len(self.words), len(words) + 1)
        return {pair for k, d in self._parts(words, everything) for pair in zip(k.tolist(), d.tolist())}

    def _promising(self, words: np.ndarray, item: np.ndarray, diagonals: np.ndarray) -> list[tuple[int, int]]:
        """(equal words, diagonal) of the diagonals with an overlap, the most equal words first.

        There is one exactly if a run of the least length that counts, or longer, has the share:
        if the sum behind it is not below the lowest sum so much further ahead.
        """
        size = len(item)
        least = min(max(min(self.least_words, size), min(math.ceil(self.item_share * size), self.long_run + 1)), size)
        found = []
        at_once = max(1, PAIRS_AT_ONCE // size)
        for k in range(0, len(diagonals), at_once):
            own = diagonals[k : k + at_once]
            places = own[:, None] + np.arange(size)
            equal = (places >= 0) & (places < len(words))
            equal &= words[np.clip(places, 0, len(words) - 1)] == item
            sums = np.zeros((len(own), size + 1))
            np.cumsum(np.where(equal, 1.0 - self.identity, -self.identity), axis=1, out=sums[:, 1:])
            lows = np.minimum.accumulate(sums, axis=1)
            some = (lows[:, : size + 1 - least] <= sums[:, least:] + 1e-9).any(axis=1)
            found += zip(equal.sum(axis=1)[some].tolist(), own[some].tolist())
        return sorted(found, key=lambda f: (-f[0], f[1]))

    def _enough(self, n: int, equal: int, size: int) -> bool:
        """Whether a run of n words, of which so many are equal, is an overlap with an item of `size` words."""
        whole = n >= self.item_share * size or n > self.long_run
        return n >= min(self.least_words, size) and equal >= self.identity * n and whole

    def _overlap(self, words: np.ndarray, item: np.ndarray, diagonal: int):
        """(first word, words, equal words) of the overlap on a diagonal, or None.

        The run with the most equal words beyond the share asked for or, where that one is too
        short, the longest run with the share: if any run is an overlap, the longest is.
        """
        begin = max(0, diagonal)
        end = min(len(words), diagonal + len(item))
        equal = words[begin:end] == item[begin - diagonal : end - diagonal]
        size = len(item)
        least = max(min(self.least_words, size), min(self.item_share * size, self.long_run))
        if np.count_nonzero(equal) < self.identity * least - 1e-9:  # no run can be long enough
            return None
        # An equal word weighs 1 - identity and another - identity: a run has the share if its sum is not negative.
        sums = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0 - self.identity, -self.identity))])
        lows = np.minimum.accumulate(sums)
        last = int(np.argmax(sums - lows))
        first = int(np.flatnonzero(sums[: last + 1] == lows[last])[-1]) if last else 0
        n_equal = int(equal[first:last].sum())
        if not self._enough(last - first, n_equal, size):
            # The longest run up to each place begins at the first low that is not above its sum.
            firsts = np.searchsorted(-lows, -sums - 1e-9)
            last = int(np.argmax(np.arange(len(sums)) - firsts))
            first = int(firsts[last])
            n_equal = int(equal[first:last].sum())
            if not self._enough(last - first, n_equal, size):
                return None
        return begin + first, last - first, n_equal

    def hits(self, data: bytes) -> list[tuple]:
        """The best overlap with each item, by item."""
        words = word_hashes(data)
        best: dict[int, tuple] = {}
        # Nothing beats a whole item but the same further ahead: diagonals behind it are left out.
        done = np.full(len(self.words), len(words) + 1)
        for items, diagonals in self._parts(words, done):
            for k in np.unique(items).tolist():
                item = self.words[k]
                for most, diagonal in self._promising(words, item, np.unique(diagonals[items == k])):
                    equal, ahead, *_ = best.get(k, (0, 0))
                    if most < equal or (most == equal and diagonal > -ahead):
                        continue  # it has no more equal words, or as many further behind
                    overlap = self._overlap(words, item, diagonal)
                    if overlap is None:
                        continue
                    first, n, equal = overlap
                    found = (equal, -first, n, n / len(item))
                    if k not in best or found > best[k]:
                        best[k] = found
                    if equal == len(item):
                        done[k] = min(done[k], diagonal)
        return [(self.item_ids[k], -f, n, e, s) for k, (e, f, n, s) in sorted(best.items())]


def blocks(
    benchmark: DataFrame, id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS, **options
) -> Iterator[Block]:
    """The test items in blocks of about block_words words (one item at least)."""
    items = benchmark.select(F.col(id).cast("bigint").alias("id"), text_bytes(text).alias("text"))
    # Every word takes two bytes at least, so bytes bound the words.
    size = items.agg((F.sum(F.octet_length("text") + 1) / 2).alias("n")).first()["n"] or 0
    n = -(-int(size) // block_words)
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        rows = [(r["id"], bytes(r["text"])) for r in part.orderBy("id", "text").toLocalIterator()]
        if rows:
            yield Block.of(rows, **options)


def with_hits(docs: DataFrame, block: Block, text: str = "text", to: str = "_hits") -> DataFrame:
    """docs with an array `to` of the overlaps with a block's items."""
    sent = docs.sparkSession.sparkContext.broadcast(block)  # of a bounded size, by blocks()

    def find(texts: pa.Array) -> pa.Array:
        own = sent.value
        rows = [own.hits(t) for t in texts.to_pylist()]
        offsets = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
        columns = list(zip(*[h for r in rows for h in r])) or [[]] * 5
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        names = [f.split(":")[0] for f in HIT.split(",")]
        flat = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        return pa.ListArray.from_arrays(offsets, flat)

    return docs.withColumn(to, once(find, f"array<struct<{HIT}>>")(text_bytes(text)))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", **options
) -> DataFrame:
    """(id, item_id, first_word, n_words, n_equal, share_of_item) of every overlap found."""
    found = None
    rows = docs.select(F.col(id), F.col(text).alias("_text"))
    for block in blocks(benchmark, item_id, item_text, **options):
        part = with_hits(rows, block, "_text").select(F.col(id), F.explode("_hits").alias("_hit")).select(id, "_hit.*")
        found = part if found is None else found.union(part)
    if found is None:
        hit = F.from_json(F.lit(None).cast("string"), HIT.replace(":", " "))
        found = docs.where(F.lit(False)).select(id, hit.alias("_hit")).select(id, "_hit.*")
    return found.withColumnRenamed("item_id", item_id) if item_id != "item_id" else found


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", **options) -> DataFrame:
    """The documents without an overlap, with their own columns only."""
    for block in blocks(benchmark, item_id, **options):
        to = unused(docs, "hits")
        docs = with_hits(docs, block, text, to).where(F.size(to) == 0).drop(to)
    return docs

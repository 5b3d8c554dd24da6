"""Near-duplicates by SimHash: fingerprints, BK-trees of their shards, components of links.

Two fingerprints that differ in at most `radius` bits agree in at least k of radius + k blocks
of bits. Every choice of k blocks with bits of theirs is therefore the key of a shard, and
linked fingerprints share one at least. The number of fingerprints decides on k and on how many
bits a key has, so that a shard holds about `SHARD` of them at any size of the corpus: a key
narrows the search, the tree does it. The fingerprints of a shard form a BK-tree (children
keyed by their integer Hamming distance to the parent); each is searched following only the
edges within the radius. Trees travel to their queries by shard key: all trees together grow
with the corpus and may not pass through the driver, as a broadcast does. A shard of more than
`MAX_TREE` fingerprints is cut into trees of about that size, and every pair of its parts is
searched in a cell of its own, in any task.

Equal fingerprints are one class from the start, so copies are never expanded into pairs, and
the cells give back a spanning forest of their links instead of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .shared import hot_join, kept, once, text_bytes, unused

RADIUS = 4
SHINGLE = 4
SEED = 42

# Fingerprints in one BK-tree at most, about; larger shards are cut.
MAX_TREE = 2_048

# Fingerprints in a shard on average, about, and the blocks that a key is of at most.
SHARD = 512
MAX_BLOCKS = 3

_BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE_ROW = np.arange(8) * 256


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 for a text without words."""
    words = data.lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((rows + _BYTE_ROW).ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ _BITS_OF_BYTE).ravel()
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    found = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64)
    return pa.array(found.view(np.int64), pa.int64())


def with_fingerprint(docs: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """docs with the SimHash as a signed long; a null text counts as empty."""
    return docs.withColumn(to, once(_fingerprints, "bigint")(text_bytes(text)))


class BKTree:
    """Values and their children by Hamming distance."""

    def __init__(self):
        self.root: list | None = None

    def add(self, value: int, label: int) -> None:
        if self.root is None:
            self.root = [value, label, {}]
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            if distance not in node[2]:
                node[2][distance] = [value, label, {}]
                return
            node = node[2][distance]

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Labels of the values at most radius bits away."""
        left = [self.root] if self.root else []
        while left:
            node = left.pop()
            distance = (node[0] ^ value).bit_count()
            if distance <= radius:
                yield node[1]
            children = node[2]
            if children:
                if len(children) <= 2 * radius + 1:
                    left.extend(
                        child
                        for d, child in children.items()
                        if distance - radius <= d <= distance + radius
                    )
                else:
                    for d in range(distance - radius, distance + radius + 1):
                        if d in children:
                            left.append(children[d])


def cell_links(values: list[int], in_tree: list[bool], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the tree's values and all values of a cell.

    Each value is a 64-bit integer; those in the tree are searched for by every value.
    """
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree, links = BKTree(), []

    def search(i: int) -> None:
        for j in tree.within(values[i], radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, j))

    for i, value in enumerate(values):
        if in_tree[i]:  # the later value of a pair finds the earlier one
            search(i)
            tree.add(value, i)
    for i, own in enumerate(in_tree):
        if not own:
            search(i)
    return links


def shard_plan(n: int, radius: int, shard: int = SHARD) -> tuple[int, int]:
    """(blocks of a key, bits of each) for shards of about `shard` of n fingerprints.

    Keys of one block are the fewest, but have few bits; of more, each fingerprint has more keys.
    """
    wanted = max(0, (n - 1) // shard).bit_length()
    for k in range(1, MAX_BLOCKS + 1):
        width = 64 // (radius + k)
        if k * width >= wanted:
            return k, -(-wanted // k)
    return MAX_BLOCKS, width


def shard_keys(fingerprint: str, radius: int, n: int, shard: int = SHARD) -> Column:
    """The keys, an array of longs, of the shards that one of n fingerprints belongs to."""
    k, bits = shard_plan(n, radius, shard)
    if bits == 0:
        return F.array(F.lit(0).cast("long"))
    count = radius + k
    mask = F.lit((1 << bits) - 1).cast("long")
    parts = [F.shiftrightunsigned(fingerprint, 64 * i // count).bitwiseAND(mask) for i in range(count)]
    keys = []
    for number, chosen in enumerate(combinations(parts, k)):
        key = F.lit(number).cast("long")
        for part in chosen:
            key = F.shiftleft(key, bits).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def _search(radius: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell may go on in the next batch."""
        held = None
        for batch in batches:
            cells = np.stack(
                [batch[c].to_numpy(zero_copy_only=False) for c in ("key", "one", "other")]
            )
            values = batch["fingerprint"].to_numpy(zero_copy_only=False).view(np.uint64)
            own = batch["in_tree"].to_numpy(zero_copy_only=False)
            if held is not None:
                cells = np.concatenate([held[0], cells], axis=1)
                values, own = np.concatenate([held[1], values]), np.concatenate([held[2], own])
            if not len(values):
                continue
            begins = np.flatnonzero(
                np.concatenate([[True], (cells[:, 1:] != cells[:, :-1]).any(axis=0)])
            )
            last = begins[-1]
            held = cells[:, last:], values[last:], own[last:]
            yield _links_of(values, own, [*begins], radius)
        if held is not None:
            yield _links_of(held[1], held[2], [0, len(held[1])], radius)

    return search


def _links_of(values: np.ndarray, own: np.ndarray, edges: list[int], radius: int):
    """Links of the cells between consecutive edges."""
    a, b = [], []
    sizes = np.diff(edges)
    for k in np.flatnonzero(sizes > 1):
        part = slice(edges[k], edges[k + 1])
        cell = values[part].tolist()
        for i, j in cell_links(cell, own[part].tolist(), radius):
            a.append(cell[i])
            b.append(cell[j])
    columns = [pa.array(np.array(x, np.uint64).view(np.int64), pa.int64()) for x in (a, b)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def links(
    fingerprints: DataFrame, radius: int = RADIUS, max_tree: int = MAX_TREE, shard: int = SHARD
) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints at most radius bits apart.

    Not all pairs, but enough of them to connect what is connected. The result does not depend
    on `shard`, the fingerprints of a shard on average, nor on `max_tree`.
    """
    keys = shard_keys("fingerprint", radius, fingerprints.count(), shard)
    members = fingerprints.select("fingerprint", F.explode(keys).alias("key"))
    # Shards beyond one tree are cut into `parts`; the other ones are not in this table.
    large = (
        members.groupBy("key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > max_tree)
        .select("key", F.ceil(F.col("n") / max_tree).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("fingerprint"), parts).cast("int")
    cells = (
        hot_join(members, large, ["key"], "left")
        .select("key", "fingerprint", parts.alias("parts"), mine.alias("part"))
        .select("key", "fingerprint", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("met"))
        .select(
            "key",
            F.least("part", "met").alias("one"),
            F.greatest("part", "met").alias("other"),
            "fingerprint",
            (F.col("part") <= F.col("met")).alias("in_tree"),
        )
        .repartition("key", "one", "other")
        .sortWithinPartitions("key", "one", "other", "fingerprint")
    )
    return cells.mapInArrow(_search(radius), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    max_tree: int = MAX_TREE,
) -> DataFrame:
    """(id, fingerprint as a signed long, component_id) of every row of docs.

    component_id is the smallest id that can be reached over links of at most radius bits, own
    id included. Null texts count as empty; all texts without words have fingerprint 0. Null
    ids never are a component's id unless it has no other. Repeated rows are repeated.
    """
    rows = with_fingerprint(docs.select(F.col(id).alias("id"), F.col(text).alias("_text")), "_text")
    rows = kept(rows.select("id", "fingerprint"), "fingerprints")
    n = rows.count()
    classes = kept(rows.groupBy("fingerprint").agg(F.min("id").alias("least")), "classes", n)
    roots = components(links(classes.select("fingerprint"), radius, max_tree), n)
    rooted = hot_join(classes.withColumnRenamed("fingerprint", "node"), roots, ["node"], "left").select(
        F.col("node").alias("fingerprint"), F.coalesce("root", "node").alias("root"), "least"
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = hot_join(rooted, least, ["root"]).select("fingerprint", "component_id")
    joined = hot_join(rows, named, ["fingerprint"])
    return joined.select(F.col("id").alias(id), "fingerprint", "component_id")


def first_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents whose id is their component's, each id once, with their own columns.

    Of repeated rows of one id any one stays; documents without an id are all kept.
    """
    found = near_duplicates(docs, id, text, **options)
    first, rows = unused(docs, "first"), unused(docs, "rows")
    firsts = kept(
        found.where(F.col(id) == F.col("component_id"))
        .groupBy(F.col(id).alias(first))
        .agg(F.count("*").alias(rows)),
        "firsts",
        docs.count(),
    )
    same = F.col(id) == F.col(first)
    repeated = firsts.where(F.col(rows) > 1)
    # Merged, never broadcast: the list of ids grows with the documents.
    whole = docs.join(firsts.hint("merge"), same, "left_semi")
    if not repeated.isEmpty():
        whole = docs.join(firsts.where(F.col(rows) == 1).hint("merge"), same, "left_semi").union(
            docs.join(repeated, same, "left_semi").dropDuplicates([id])
        )
    return whole.union(docs.where(F.col(id).isNull()))

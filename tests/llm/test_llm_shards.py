"""Shards of fingerprints: of one size at any size of the corpus, searched by trees that prune."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from namepulse.llm import simhash
from test_llm_tables import brute_components

MASK = 2**64 - 1


def near(rng, n):
    """Values of which each third one is within 4 bits of another."""
    values = [int(v) for v in rng.integers(-(2**63), 2**63, n)]
    for i in range(0, n - 1, 3):
        flips = rng.choice(64, int(rng.integers(0, 6)), replace=False)
        values[i] = (values[i + 1] & MASK) ^ sum(1 << int(b) for b in flips)
    return sorted({v - 2**64 if v >= 2**63 else v for v in values})


@pytest.mark.parametrize("n, plan", [(0, (1, 0)), (1, (1, 0)), (512, (1, 0)), (513, (1, 1)), (9_296, (1, 5)),
                                     (2 * 10**6, (1, 12)), (10**8, (2, 9)), (10**10, (3, 9)), (10**12, (3, 9))])
def test_plan(n, plan):
    assert simhash.shard_plan(n, 4) == plan


def test_shards_keep_their_size():
    for power in range(9, 36):
        k, bits = simhash.shard_plan(1 << power, 4)
        assert simhash.SHARD / 4 <= (1 << power) / (1 << k * bits) <= simhash.SHARD


@pytest.mark.parametrize("k_of", [1, 2, 3])
@pytest.mark.parametrize("radius", [0, 1, 4])
def test_linked_values_share_a_shard(spark, radius, k_of, monkeypatch):
    monkeypatch.setattr(simhash, "shard_plan", lambda n, radius, shard: (k_of, min(18, 64 // (radius + k_of))))
    rng = np.random.default_rng(radius)
    pairs = []
    for _ in range(200):
        a = int(rng.integers(0, 2**63))
        b = a ^ sum(1 << int(i) for i in rng.choice(63, radius, replace=False))
        pairs.append((a, b))
    keys = [simhash.shard_keys(c, radius, 9).alias(f"k{c}") for c in "ab"]
    table = spark.createDataFrame(pairs, "a long, b long").select(*keys)
    assert table.where(F.arrays_overlap("ka", "kb")).count() == 200


@pytest.mark.parametrize("shard, max_tree", [(1, 2_048), (4, 2_048), (64, 2_048), (4, 3), (1_000, 7)])
def test_links_do_not_depend_on_shards(spark, shard, max_tree):
    values = near(np.random.default_rng(5), 240)
    table = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = [(r["a"], r["b"]) for r in simhash.links(table, 4, max_tree, shard).collect()]
    true = [(a, b) for a, b in combinations(values, 2) if ((a ^ b) & MASK).bit_count() <= 4]
    assert len(true) > 40 and {tuple(sorted(x)) for x in found} <= set(true)
    assert brute_components(found) == brute_components(true)


def test_cells_with_values_outside_the_tree():
    values = [v & MASK for v in near(np.random.default_rng(7), 300)]
    own = [i % 2 == 0 for i in range(len(values))]
    links = simhash.cell_links(values, own, 4)
    true = [(i, j) for i, j in combinations(range(len(values)), 2)
            if (own[i] or own[j]) and (values[i] ^ values[j]).bit_count() <= 4]
    assert {tuple(sorted(x)) for x in links} <= set(true)
    assert brute_components(links) == brute_components(true)


def test_trees_prune():
    """Of a shard's pairs less than two in five are looked at."""
    values = [int(v) for v in np.random.default_rng(8).integers(0, 2**59, simhash.SHARD)]
    looked = 0

    class Counted(int):
        def __xor__(self, other):
            nonlocal looked
            looked += 1
            return int(self) ^ int(other)

    tree = simhash.BKTree()
    for i, value in enumerate(values):
        list(tree.within(value, 4))
        before = looked
        tree.add(Counted(value), i)
        looked = before
    assert 0 < looked < 0.4 * len(values) * (len(values) - 1) / 2

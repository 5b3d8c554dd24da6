"""Seeds that all skip positions, texts of few words, and the best overlap by brute force."""

import random
import time
from itertools import combinations

import pytest
from hypothesis import given, settings, strategies as st

from namepulse.llm import decontamination


def test_every_mask_skips_positions():
    assert all("0" in m and m[0] == m[-1] == "1" and m.count("1") == 4 for m in decontamination.MASKS)


def test_every_short_run_with_the_share_has_a_seed():
    for size in range(8, 16):
        for places in combinations(range(size), size // 5):
            assert any(
                not any(i + o in places for o in decontamination._offsets(m))
                for m in decontamination.MASKS
                for i in range(size - len(m) + 1)
            )


def brute(block, text):
    """The best overlap of each item over all diagonals, hit or not."""
    words = decontamination.word_hashes(text)
    best = {}
    for k, item in enumerate(block.words):
        for diagonal in range(-len(item) + 1, len(words)):
            found = block._overlap(words, item, diagonal)
            if found:
                first, n, equal = found
                best[k] = max(best.get(k, (0, 0, 0)), (equal, -first, n))
    return [(block.item_ids[k], -f, n, e) for k, (e, f, n) in sorted(best.items())]


@given(st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_best_overlaps_by_brute_force(seed):
    """Texts and items of two or three different words, where nearly every place is a hit."""
    r = random.Random(seed)
    vocabulary = "ab" if r.random() < 0.5 else "abc"
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(8, 24))).encode()) for i in range(3)]
    text = " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))).encode()
    block = decontamination.Block.of(items)
    before = decontamination.PAIRS_AT_ONCE
    try:
        decontamination.PAIRS_AT_ONCE = r.choice([1, 7, 100, before])
        assert [h[:4] for h in block.hits(text)] == brute(block, text)
    finally:
        decontamination.PAIRS_AT_ONCE = before


@pytest.mark.parametrize("item, text", [("the ", "the "), ("the of ", "the of the the of "), ("a a b ", "a a b a "), ("x y ", "the ")])
def test_repeated_words_take_bounded_time(item, text):
    block = decontamination.Block.of([(i, (item * (20 + i)).encode()) for i in range(20)])
    began = time.time()
    block.hits((text * 20_000).encode())
    assert time.time() - began < 25

"""The packing search: optimum, undominated fillings, bounds and memory."""

from __future__ import annotations

import itertools
import random
import tracemalloc
from collections import Counter

import numpy as np
from test_texts import fewest

from logsync.llm import packing as pk


def sequences_of(counts, capacity):
    plan, held = pk.pack(counts, capacity), Counter()
    for filling, times in plan:
        assert sum(filling) <= capacity and times > 0
        for x in filling:
            held[x] += times
    assert held == Counter({x: n for x, n in counts.items() if n})
    return sum(times for _, times in plan)


def test_three_middling_pieces_make_a_sequence():
    lengths = np.random.default_rng(0).integers(600, 761, 200_000)
    counts = Counter(lengths.tolist())
    # No four go together, so a third of the pieces is a bound.
    assert pk.waste_bound(counts, 2048) >= 66_667
    assert sequences_of(counts, 2048) <= 66_700


def test_lengths_of_texts_need_no_more_than_the_bound():
    lengths = np.clip(np.random.default_rng(0).lognormal(6, 1, 256_410), 1, 2048).astype(int)
    counts = Counter(lengths.tolist())
    tracemalloc.start()
    found, needed = pk.sequences_needed(counts, 2048)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == needed
    # Counts, sums of 2,048 bits for each length, the path and the states met.
    assert most < 20e6


def test_memory_stays_bounded_where_the_bound_is_not_met():
    counts = Counter(np.random.default_rng(5).integers(200, 1000, 150).tolist())
    tracemalloc.start()
    assert sequences_of(counts, 2048) <= pk.waste_bound(counts, 2048) + 2
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20e6


def fits_into(small, large):
    """Whether the pieces of ``small`` can be put into those of ``large``."""
    if not small:
        return True
    return any(
        room >= small[0] and fits_into(small[1:], (*large[:i], room - small[0], *large[i + 1 :]))
        for i, room in enumerate(large)
    )


def test_every_filling_is_dominated_by_one_that_is_tried(monkeypatch):
    monkeypatch.setattr(pk, "BRANCHES", 10**6)
    chance = random.Random(3)
    for _ in range(40):
        items = sorted((chance.randrange(3, 25) for _ in range(9)), reverse=True)
        capacity = chance.randrange(25, 50)
        tried = list(pk.Completion(Counter(items), capacity).fillings())
        wastes = [capacity - sum(f) for f in tried]
        assert wastes == sorted(wastes) and len(set(tried)) == len(tried)
        for size in range(len(items)):
            for rest in itertools.combinations(items[1:], size):
                if items[0] + sum(rest) <= capacity:
                    assert any(fits_into(rest, filling[1:]) for filling in tried), (items, capacity, rest)


def test_the_optimum_of_many_small_cases():
    chance = random.Random(21)
    for _ in range(40):
        capacity = chance.randrange(30, 80)
        items = sorted((chance.randrange(5, capacity // 2 + 8) for _ in range(13)), reverse=True)
        best = fewest(items, capacity)
        assert pk.waste_bound(Counter(items), capacity) <= best
        assert sequences_of(Counter(items), capacity) == best


def test_states_are_restored_when_a_choice_is_taken_back():
    counts = Counter([9, 8, 8, 5, 5, 5, 3, 2])
    pieces = pk.Completion(counts, 16)
    before = (pieces.state, list(pieces.lengths), pieces.left.tolist())
    pieces.use((8, 8), 1)
    pieces.use((9, 5, 2), 1)
    assert pieces.lengths == [3, 5]
    pieces.use((9, 5, 2), -1)
    pieces.use((8, 8), -1)
    assert (pieces.state, pieces.lengths, pieces.left.tolist()) == before


def test_no_pieces_need_no_sequence():
    assert pk.pack({}, 8) == [] and pk.waste_bound({}, 8) == 0
    assert sequences_of({8: 3, 1: 8}, 8) == 4

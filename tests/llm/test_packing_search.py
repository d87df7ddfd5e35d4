"""The packing search against exhaustive search and against packings known to be perfect."""

import random

import numpy as np
import pytest

from thermaspark.llm import packing


def counts_of(sizes, capacity):
    return np.bincount(sizes, minlength=capacity + 1).astype(np.int64)


def held(found, sizes, capacity):
    assert all(sum(f) <= capacity for f in found)
    assert sorted(u for f in found for u in f) == sorted(sizes)
    return len(found)


def exhaustive(sizes, capacity):
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in sorted({q for q in rooms if q >= sizes[i]}):
            rest = list(rooms)
            rest.remove(room)
            go(i + 1, [*rest, room - sizes[i]])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best[0]


def test_a_case_that_needs_wasteful_fillings():
    sizes = [7, 8, 9, 12, 14, 15, 23, 29, 31]
    assert held(packing.bounded_search(counts_of(sizes, 50), 50), sizes, 50) == 3


@pytest.mark.parametrize("seed", range(5))
def test_optimum_of_small_cases(seed):
    r = random.Random(seed)
    for _ in range(60):
        capacity = r.choice([20, 50, 64])
        sizes = [r.randint(1, capacity) for _ in range(r.randint(1, 10))]
        assert held(packing.bounded_search(counts_of(sizes, capacity), capacity), sizes, capacity) == exhaustive(sizes, capacity)


@pytest.mark.parametrize("seed", range(5))
def test_perfect_packings_are_found(seed):
    r = random.Random(seed)
    for _ in range(150):
        bins, sizes = r.randint(1, 10), []
        for _ in range(bins):
            cuts = sorted(r.sample(range(1, 100), r.randint(0, 3)))
            sizes += [b - a for a, b in zip([0, *cuts], [*cuts, 100], strict=True)]
        assert held(packing.bounded_search(counts_of(sizes, 100), 100), sizes, 100) == bins


def test_best_fit_of_a_histogram_is_best_fit_piece_by_piece():
    r = random.Random(3)
    for _ in range(100):
        sizes = [r.randint(1, 60) for _ in range(r.randint(0, 60))]
        rooms = []
        for u in sorted(sizes, reverse=True):
            fit = min((q for q in rooms if q >= u), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((64 if fit is None else fit) - u)
        found = [f for f, n in packing.best_fit(counts_of(sizes, 64), 64) for _ in range(n)]
        assert sorted(64 - sum(f) for f in found) == sorted(rooms)
        held(found, sizes, 64)


@pytest.mark.parametrize("seed", range(3))
def test_plan_holds_the_histogram_and_is_no_worse_than_best_fit(seed):
    r = np.random.default_rng(seed)
    sizes = r.integers(1, 1025, 4000)
    histogram = {k: int(n) for k, n in enumerate(np.bincount(sizes)) if n}
    found = packing.plan(histogram)
    got = np.zeros(1025, np.int64)
    for f, n in found:
        assert sum(f) <= 1024
        np.add.at(got, list(f), n)
    assert (got == counts_of(sizes, 1024)).all()
    assert packing.used(found) <= packing.used(packing.best_fit(counts_of(sizes, 1024), 1024))


def test_dominance():
    unused = lambda *sizes: sum(1 << u for u in sizes)
    assert packing.dominated((5,), 3, unused(3))  # a piece fits behind it
    assert packing.dominated((5, 4), 1, unused(6))  # 6 for 5
    assert packing.dominated((5, 4), 0, unused(9))  # 9 for 5 and 4
    assert not packing.dominated((5, 4), 0, unused(5, 4, 8))
    assert not packing.dominated((5, 4), 1, unused(3, 7, 8))
    assert packing.dominated((5, 4), 1, unused(10))

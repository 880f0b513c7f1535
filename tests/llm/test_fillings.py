"""The packing of sizes against an exhaustive packer."""

import random
from functools import cache

from titleprep.llm.fillings import best_fit, exhaustive, pack


def fewest(items, capacity):
    """The least number of bins, by trying every bin for every item."""

    @cache
    def fits(rest, gaps):
        if not rest:
            return True
        return any(
            fits(rest[1:], tuple(sorted((*gaps[:i], gap - rest[0], *gaps[i + 1 :]))))
            for i, gap in enumerate(gaps)
            if gap >= rest[0] and gap not in gaps[:i]
        )

    bins = -(-sum(items) // capacity)
    while not fits(tuple(sorted(items, reverse=True)), (capacity,) * bins):
        bins += 1
    return bins


def used(fillings, counts, capacity):
    left = dict(counts)
    for filling, bins in fillings:
        assert bins > 0 and sum(s * n for s, n in filling) <= capacity
        for size, n in filling:
            left[size] -= n * bins
    assert not any(left.values())
    return sum(n for _, n in fillings)


def test_fewer_copies_than_fit():
    for counts, capacity, bins in (({20: 2, 5: 2, 3: 4}, 31, 2), ({2640: 1000, 660: 1000, 398: 2000}, 4096, 1000)):
        assert used(best_fit(counts, capacity), counts, capacity) > bins
        assert used(pack(counts, capacity), counts, capacity) == bins


def test_skewed_counts():
    for seed in range(150):
        rng = random.Random(seed)
        capacity = rng.choice([20, 31, 50])
        counts = {rng.randint(2, capacity): rng.choice([1, 1, 2, 4]) for _ in range(rng.randint(1, 5))}
        bins = fewest([s for s, n in counts.items() for _ in range(n)], capacity)
        assert used(pack(counts, capacity), counts, capacity) == bins, counts
        assert exhaustive(counts, capacity, bins - 1) is None

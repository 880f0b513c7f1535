"""Bin packing over a histogram of sizes.

Sizes are integers up to the capacity, so however many items there are, the
problem is a table of at most ``capacity`` counts, and a packing is a short list
of fillings with the number of bins that use each.

Best fit decreasing gives the first solution.  If it needs more bins than the sum
of the sizes does, a quick bin completion (``completed``, few fillings of each gap) and
then a full one (``exhaustive``) try to save some: the largest item left is completed by
undominated fillings of its gap, with every multiple of every size, each used as often
as the counts allow and then less often; a branch ends when its waste exceeds what the
bins tried for leave over.  The lower bound is tried for first, then the
number of bins is halved until the bounds meet.  A full search that ends is a proof; one that runs out of steps is none, and
the numbers above it are tried.  The best solution found stays; the steps cost bins at
worst, never items.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

_BRANCHES = 12
_STEPS = 100_000  # work of the full search for each number of bins tried, in sizes looked at

Filling = tuple[tuple[int, int], ...]  # (size, how often), largest first


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best fit decreasing; equal items are placed together."""
    by_gap: dict[int, list[tuple[Filling, int]]] = {}
    gaps: list[int] = []  # sorted gaps of open bins

    def put(gap: int, filling: Filling, bins: int) -> None:
        if gap not in by_gap:
            by_gap[gap] = []
            gaps.insert(bisect_right(gaps, gap), gap)
        by_gap[gap].append((filling, bins))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            place = bisect_right(gaps, size - 1)
            if place < len(gaps):
                gap = gaps[place]
                filling, bins = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[place]
            else:
                gap, filling, bins = capacity, (), left
            # an open bin that still has room is the fullest that fits, so it is filled first
            each = min(gap // size, left)
            used = min(bins, left // each)
            put(gap - each * size, (*filling, (size, each)), used)
            left -= each * used
            if filling and bins > used:
                put(gap, filling, bins - used)
    return [(f, n) for held in by_gap.values() for f, n in held]


def _completions(gap: int, sizes: list[int], counts: Counter, most: int) -> list[Filling]:
    """Fillings of ``gap``, least waste first; at most ``most`` steps of search.

    ``sizes`` are the sizes left, smallest first.  A filling ends only when nothing
    left fits: one that stops before is dominated by the one that goes on.
    """
    found: list[tuple[int, int, Filling]] = []
    steps = 0

    def search(gap: int, below: int, chosen: Filling) -> None:
        nonlocal steps
        steps += 1
        place = bisect_right(sizes, gap, 0, below) - 1
        tried = 0
        while place >= 0 and tried < _BRANCHES and (steps <= most or not tried):
            size = sizes[place]
            times = min(gap // size, counts[size])
            if times:
                tried += 1
                search(gap - times * size, place, (*chosen, (size, times)))
                if found[0][0] == 0:
                    return
            place -= 1
        if not tried:
            found.append((gap, sum(n for _, n in chosen), chosen))
            found.sort()

    search(gap, len(sizes), ())
    return [f for _, _, f in found]


def completed(
    counts: dict[int, int], capacity: int, bins: int, most: int = 300
) -> list[tuple[Filling, int]] | None:
    """A packing with at most ``bins`` bins, or None if the search turns back ``most`` times."""
    allowed = bins * capacity - sum(s * n for s, n in counts.items())
    if allowed < 0:
        return None
    left = Counter({s: n for s, n in counts.items() if n})
    done: list[tuple[Filling, int]] = []
    # each level: what was taken there, and the other completions of the same largest item
    levels: list[tuple[Filling, int, list[Filling], int]] = []
    waste, turns = 0, 0
    sizes = sorted(left)
    while True:
        if not sizes:
            return done
        largest = sizes[-1]
        left[largest] -= 1
        options = _completions(capacity - largest, sizes, left, 150)
        left[largest] += 1
        options = [_with(largest, o) for o in options[:4]]
        while True:
            if options:
                filling = options.pop(0)
                times = min(left[s] // n for s, n in filling)
                lost = capacity - sum(s * n for s, n in filling)
                if lost:
                    times = min(times, max((allowed - waste) // lost, 0))
                if times:
                    for s, n in filling:
                        left[s] -= n * times
                        if not left[s]:
                            del sizes[bisect_left(sizes, s)]
                    waste += lost * times
                    done.append((filling, times))
                    levels.append((filling, times, options, lost))
                    break
                options = []
            # back to the level before
            turns += 1
            if not levels or turns > most:
                return None
            filling, times, options, lost = levels.pop()
            done.pop()
            waste -= lost * times
            for s, n in filling:
                if not left[s]:
                    insort(sizes, s)
                left[s] += n * times


def _with(size: int, filling: Filling) -> Filling:
    sizes = Counter(dict(filling))
    sizes[size] += 1
    return tuple(sorted(sizes.items(), reverse=True))


class _GaveUp(Exception):
    """The search ended for its budget, not for want of packings."""


def _all_completions(gap: int, sizes: list[int], left: Counter, waste: int, spend) -> Iterator[Filling]:
    """Every undominated filling of ``gap`` that wastes at most ``waste``; ``sizes`` smallest first.

    A filling is dominated when something left would still fit.
    """
    # what is left of the sizes up to a place: a gap that they cannot fill well enough is not followed
    sums = [0, *accumulate(s * left[s] for s in sizes)]
    stack: list[tuple[int, int, int, Filling]] = [(gap, len(sizes), gap + 1, ())]
    while stack:
        spend()
        gap, below, passed, chosen = stack.pop()
        # ``passed`` is the smallest size of which some are left out
        place = bisect_right(sizes, gap, 0, below) - 1
        if gap - sums[place + 1] > waste:
            continue
        if place < 0 or not gap:
            if gap < passed and gap <= waste:
                yield chosen
            continue
        size = sizes[place]
        most = min(gap // size, left[size])
        for times in range(most + 1):  # the greatest is taken from the stack first
            least = size if times < left[size] else passed
            stack.append((gap - times * size, place, least, (*chosen, (size, times)) if times else chosen))


def exhaustive(
    counts: dict[int, int], capacity: int, bins: int, most: int = _STEPS
) -> list[tuple[Filling, int]] | None:
    """A packing with at most ``bins`` bins, or None if there is none; ``_GaveUp`` after ``most`` steps."""
    allowed = bins * capacity - sum(s * n for s, n in counts.items())
    if allowed < 0:
        return None
    left = Counter({s: n for s, n in counts.items() if n})
    steps = 0

    def spend(cost: int = 5) -> None:
        nonlocal steps
        steps += cost
        if steps > most:
            raise _GaveUp

    def choices(waste: int) -> Iterator[tuple[Filling, int]]:
        sizes = sorted(s for s, n in left.items() if n)
        spend(len(sizes))
        largest, free = sizes[-1], left.copy()
        free[largest] -= 1
        for rest in _all_completions(capacity - largest, [s for s in sizes if free[s]], free, waste, spend):
            filling = _with(largest, rest)
            lost = capacity - sum(s * n for s, n in filling)
            times = min(free[s] // n if s != largest else (free[s] + 1) // n for s, n in filling)
            if lost:
                times = min(times, waste // lost)
            # as often as it goes, then by halves, then every other number
            halves = [times >> k for k in range(times.bit_length())]
            for n in chain(halves, (n for n in range(times - 1, 0, -1) if n not in halves)):
                spend()
                yield filling, n

    def lost(filling: Filling, n: int) -> int:
        return n * (capacity - sum(s * k for s, k in filling))

    done: list[tuple[Filling, int]] = []
    if not any(left.values()):
        return done
    levels = [choices(allowed)]
    while levels:
        if (choice := next(levels[-1], None)) is None:
            levels.pop()
            if done:
                filling, n = done.pop()
                allowed += lost(filling, n)
                for s, k in filling:
                    left[s] += k * n
            continue
        filling, n = choice
        for s, k in filling:
            left[s] -= k * n
        allowed -= lost(filling, n)
        done.append(choice)
        if not any(left.values()):
            return done
        levels.append(choices(allowed))
    return None


def pack(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Fillings and the number of bins of each, in as few bins as were found."""
    counts = {s: n for s, n in counts.items() if n}
    # an item as large as a bin is alone in it
    full = [(((capacity, 1),), counts.pop(capacity))] if capacity in counts else []
    best = best_fit(counts, capacity)
    least = -(-sum(s * n for s, n in counts.items()) // capacity)
    used = sum(n for _, n in best)
    for search in (completed, exhaustive):
        # bounds of what this search still tries; only an exhausted one is a proof
        low, tried = least, least
        while low < used:
            try:
                better = search(counts, capacity, tried)
                proven = search is exhaustive
            except _GaveUp:
                better, proven = None, False
            if better is not None:
                best, used = better, sum(n for _, n in better)
            else:
                if proven:
                    least = max(least, tried + 1)
                # the lower bound is tried first and by itself: no waste at all is the quickest to search
                low = tried + 1
            tried = (low + used) // 2
    return full + best

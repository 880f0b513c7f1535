"""Best-fit decreasing over counts of lengths, and the cuts that fill what it leaves open.

Items of one length follow each other in best-fit decreasing, so whole groups of equal
windows are handled at a time: the work depends on the number of different lengths, at
most ``capacity``, and not on the number of items.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from dataclasses import dataclass

import numpy as np

RANKS = 1 << 40


class OpenWindows:
    """A segment tree over remaining capacities; a leaf holds runs (first window, number of windows)."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._filled = bytearray(2 * self._leaves)
        self.runs = [deque() for _ in range(capacity + 1)]

    def _mark(self, remaining: int) -> None:
        at = self._leaves + remaining
        self._filled[at] = bool(self.runs[remaining])
        while at > 1:
            at //= 2
            self._filled[at] = self._filled[2 * at] or self._filled[2 * at + 1]

    def put(self, remaining: int, run: tuple[int, int], front: bool = False) -> None:
        (self.runs[remaining].appendleft if front else self.runs[remaining].append)(run)
        self._mark(remaining)

    def take(self, remaining: int) -> tuple[int, int]:
        run = self.runs[remaining].popleft()
        self._mark(remaining)
        return run

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that a window has."""
        at = self._leaves + need
        while not self._filled[at]:
            while at & 1:  # a right child: nothing lies to the right below this parent
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self._leaves:
            at = 2 * at if self._filled[2 * at] else 2 * at + 1
        return at - self._leaves


@dataclass(frozen=True)
class Run:
    """Items of ``length`` from ``rank`` on: ``times`` in each of ``windows`` windows, the first at ``place``."""

    length: int
    rank: int
    first: int
    windows: int
    times: int
    place: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[Run], list[tuple[int, int, int]]]:
    """Where items go, and the windows as (used, first window, number of windows)."""
    tree, runs, opened = OpenWindows(capacity), [], 0

    def fill(length, rank, first, windows, times, remaining):
        runs.append(Run(length, rank, first, windows, times, capacity - remaining))
        tree.put(remaining - times * length, (first, windows))
        return rank + windows * times

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, count = 0, counts[length]
        while rank < count:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first, windows = capacity, opened, -(-(count - rank) // (capacity // length))
                opened += windows
            else:
                first, windows = tree.take(remaining)
            times = remaining // length
            full = min(windows, (count - rank) // times)
            if full:
                rank = fill(length, rank, first, full, times, remaining)
            if full < windows:
                # the tightest window that is left takes what is left of this length
                rest = first + full
                if rank < count:
                    rank = fill(length, rank, rest, 1, count - rank, remaining)
                    rest += 1
                if rest < first + windows:
                    tree.put(remaining, (rest, first + windows - rest), front=True)
    return runs, [(capacity - r, *run) for r in range(capacity + 1) for run in tree.runs[r]]


def _dealt(windows, capacity):
    """Windows that stay, with gaps to fill, and windows to be cut up, both as (used, first, number)."""
    # a window whose length is a power of two needs no padding
    partly = sorted((w for w in windows if w[0] & (w[0] - 1)), key=lambda w: (-w[0], w[1]))
    tokens = sum(used * n for used, _, n in partly)
    stay, cut, left = [], [], tokens // capacity
    for used, first, n in partly:
        kept = min(left, n)
        left -= kept
        if kept:
            stay.append((used, first, kept))
        if kept < n:
            cut.append((used, first + kept, n - kept))
    return stay, cut, tokens % capacity


@dataclass(frozen=True)
class Layout:
    """``slots``: by length and rank, the window or, where ``stream`` >= 0, the place in the stream
    of items that are cut up.  ``gaps``: by place in that stream, the windows that take it."""

    slots: dict[str, np.ndarray]
    gaps: dict[str, np.ndarray]
    cut_lengths: list[int]


def layout(counts: dict[int, int], capacity: int) -> Layout:
    """Best-fit decreasing; then the emptiest windows are cut up so that no sequence needs padding.

    The fullest windows stay and take the items of the others one after the other, an
    item being cut where a window is full.  What remains, less than one window, goes
    into sequences whose lengths are powers of two.
    """
    runs, windows = best_fit_decreasing(counts, capacity)
    stay, cut, remainder = _dealt([w for w in windows if w[0] < capacity], capacity)
    new = sum(n for _, _, n in windows)
    gaps, at = [], 0
    for used, first, n in stay:
        gaps.append((at, capacity - used, first, used))
        at += n * (capacity - used)
    for bit in reversed(range(capacity.bit_length())):
        if remainder >> bit & 1:
            gaps.append((at, 1 << bit, new, 0))
            at, new = at + (1 << bit), new + 1

    streams, base = [], 0  # (first window, number, used, place in the stream)
    for used, first, n in cut:
        streams.append((first, n, used, base))
        base += n * used
    streams.sort()
    starts = [s[0] for s in streams]

    slots = []
    for run in runs:
        window, end = run.first, run.first + run.windows
        near = max(bisect_right(starts, window) - 1, 0)
        while window < end:
            while near < len(streams) and streams[near][0] + streams[near][1] <= window:
                near += 1
            begin, n, used, base = streams[near] if near < len(streams) else (end, 0, 0, 0)
            inside = begin <= window
            until = min(end, begin + n if inside else begin)
            stream = base + (window - begin) * used + run.place if inside else -1
            rank = run.rank + (window - run.first) * run.times
            slots.append((run.length * RANKS + rank, window, run.times, run.place, stream, used))
            window = until

    def table(rows, names):
        columns = np.array(sorted(rows), np.int64).reshape(-1, len(names)).T
        return {name: column.copy() for name, column in zip(names, columns)}

    return Layout(
        table(slots, ("key", "window", "times", "place", "stream", "used")),
        table(gaps, ("stream", "gap", "window", "used")),
        sorted({row[0] // RANKS for row in slots if row[4] >= 0}),
    )

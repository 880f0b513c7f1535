"""A run-length index over a set of byte strings, and the matches that it finds.

The strings are joined, their suffixes sorted (prefix doubling) and the
Burrows-Wheeler transform is reduced to its runs.  Only at the ends of runs is a
sample kept: the place in the text and the length of the match with the
neighbouring suffix.  Along a run the match of the next place in the text is one
shorter, so walking through the text from sample to sample gives every place's
longest match with the suffix before and the suffix after it in sorted order, that
is, its longest match anywhere else.  The more repetitive the strings, the fewer
the runs and the samples.
"""

from __future__ import annotations

import numpy as np

_PACKED = 7  # symbols of nine bits in one number


def _suffixes(symbols: np.ndarray) -> np.ndarray:
    """Places in suffix order.  Symbol 0 ends a string; each such place is a symbol of its own."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(_PACKED, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(_PACKED):
        key = key << np.uint64(9) | padded[j : j + n]
    ends = np.flatnonzero(symbols == 0)
    key[ends] = 0
    # the ends first and in order of place, so that equal strings end in one order at every depth
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    new[: len(ends) + 1] = True
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    depth = _PACKED
    while True:
        # groups of more than one suffix are sorted by what follows
        last = np.concatenate([new[1:], [True]])
        open_ = np.flatnonzero(~(new & last))
        if not len(open_):
            return order
        places = order[open_]
        sub = (rank[places] << 32) | rank[places + depth]
        by = np.argsort(sub)
        order[open_] = places[by]
        sub = sub[by]
        differs = np.concatenate([[True], sub[1:] != sub[:-1]])
        new[open_] = differs
        heads = open_[differs]
        rank[order[open_]] = heads[np.cumsum(differs) - 1]
        depth *= 2


def _common(data: np.ndarray, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lengths of the common beginnings of suffix pairs, at most ``most``."""
    length = np.zeros(len(left), np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(
        padded.view(), shape=(len(data), 8), strides=(1, 1)
    )
    active = np.flatnonzero(most > 0)
    while len(active):
        at = length[active]
        a = eight[left[active] + at].view(np.uint64)[:, 0]
        b = eight[right[active] + at].view(np.uint64)[:, 0]
        differ = a ^ b
        same = differ == 0
        # the number of equal low bytes
        low = differ & (~differ + np.uint64(1))
        equal = np.where(same, 8, (np.log2(np.where(same, 1, low).astype(np.float64)) // 8).astype(np.int64))
        length[active] = at + equal
        active = active[same & (length[active] < most[active])]
    return np.minimum(length, most)


class RunIndex:
    """Index over ``strings``; ``matches`` walks through them."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], np.int64)
        gap = _PACKED  # so that packed symbols never reach the next string
        self.starts = np.cumsum(sizes + gap) - sizes - gap
        self.sizes = sizes
        data = np.frombuffer(bytes(gap).join([*strings, b""]), np.uint8)
        inside = np.zeros(len(data) + 1, np.int8)
        np.add.at(inside, self.starts, 1)
        np.add.at(inside, self.starts + sizes, -1)
        inside = np.cumsum(inside[:-1]).astype(bool)
        symbols = np.where(inside, data.astype(np.uint16) + 1, 0)
        order = _suffixes(symbols)
        ends = np.repeat(self.starts + sizes, sizes + gap)
        before = symbols[order - 1]  # the first place of a string follows an end
        # the transform's runs; an end is a symbol of its own, so it breaks them
        head = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)])
        tail = np.concatenate([head[1:], [True]])
        left = np.maximum(ends - np.arange(len(data)), 0)

        def samples(rows: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            places, near = order[rows], order[other]
            common = _common(data, places, near, np.minimum(left[places], left[near]))
            by = np.argsort(places)
            return places[by], common[by]

        heads, tails = np.flatnonzero(head)[1:], np.flatnonzero(tail)[:-1]
        first, last = order[[0]], order[[-1]]
        self.head_samples = _with_zero(samples(heads, heads - 1), first)
        self.tail_samples = _with_zero(samples(tails, tails + 1), last)
        self.runs = int(head.sum())
        self._length = len(data)

    def matches(self) -> list[np.ndarray]:
        """For every place of every string, its longest match at any other place."""
        longest = np.zeros(self._length, np.int64)
        for places, common in (self.head_samples, self.tail_samples):
            at = np.arange(self._length)
            sample = np.searchsorted(places, at, "right") - 1
            known = sample >= 0
            value = np.where(known, common[sample] - (at - places[sample]), 0)
            longest = np.maximum(longest, value)
        return [longest[s : s + n] for s, n in zip(self.starts.tolist(), self.sizes.tolist())]


def _with_zero(samples: tuple[np.ndarray, np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last suffix have one neighbour only."""
    places, common = np.append(samples[0], place), np.append(samples[1], 0)
    by = np.argsort(places, kind="stable")
    return places[by], common[by]

"""A ternary search tree over the sorted sequences of one shard."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np

# a turn in a sequence: its dictionary code and the bytes of its text
ELEMENT = np.dtype([("code", ">i8"), ("bytes", ">i4")])


def elements(sequence: bytes) -> tuple[list[int], list[int]]:
    """Codes and text lengths of a sequence."""
    found = np.frombuffer(sequence, ELEMENT)
    return found["code"].tolist(), found["bytes"].tolist()


def medians(n: int) -> Iterator[int]:
    """0 .. n-1, the middle first, then the middles of both halves, and so on."""
    halves = [(0, n)]
    while halves:
        start, end = halves.pop()
        if start < end:
            middle = (start + end) // 2
            yield middle
            halves += [(middle + 1, end), (start, middle)]


class PrefixTree:
    """Every node but the root 0 is a prefix; siblings are a binary tree under ``lower`` and ``higher``.

    Nodes are numbered as they come, so a child has a greater number than its parent.
    """

    def __init__(self, sequences: Sequence[bytes]):
        self.code, self.bytes = array("q", [0]), array("q", [0])
        self.lower, self.equal, self.higher = array("q", [-1]), array("q", [-1]), array("q", [-1])
        self.parent, self.depth = array("q", [-1]), array("q", [0])
        self.end = [0] * len(sequences)
        for at in medians(len(sequences)):
            self.end[at] = self._insert(sequences[at])

    def __len__(self) -> int:
        return len(self.code)

    def _new(self, parent: int, code: int, size: int) -> int:
        for column, value in (
            (self.code, code),
            (self.bytes, size),
            (self.lower, -1),
            (self.equal, -1),
            (self.higher, -1),
            (self.parent, parent),
            (self.depth, self.depth[parent] + 1),
        ):
            column.append(value)
        return len(self.code) - 1

    def _insert(self, sequence: bytes) -> int:
        node = 0
        for code, size in zip(*elements(sequence)):
            branch, at = self.equal, node
            while (to := branch[at]) >= 0 and self.code[to] != code:
                branch, at = self.lower if code < self.code[to] else self.higher, to
            if to < 0:
                to = branch[at] = self._new(node, code, size)
            node = to
        return node

    def path(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        found = []
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return found[::-1]

    def totals(self, members: Sequence[int], smallest: Sequence[int]) -> dict[str, array]:
        """By node: members, the smallest one, children, leaves and savings below it.

        ``members`` and ``smallest`` are those of the sequences the tree was made of.
        """
        n = len(self)
        count, children, leaves, saved = (array("q", bytes(8 * n)) for _ in range(4))
        least = array("q", [(1 << 63) - 1]) * n
        for node, many, first in zip(self.end, members, smallest):
            count[node], least[node] = many, first
        for node in range(n - 1, -1, -1):
            if not children[node]:
                leaves[node] = 1
            saved[node] += (count[node] - 1) * self.bytes[node]
            above = self.parent[node]
            if above >= 0:
                count[above] += count[node]
                least[above] = min(least[above], least[node])
                children[above] += 1
                leaves[above] += leaves[node]
                saved[above] += saved[node]
        return {"n_convs": count, "conv_id": least, "n_children": children, "n_leaves": leaves, "saved_tokens": saved}

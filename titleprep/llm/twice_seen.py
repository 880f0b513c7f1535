"""Two Bloom filters of fixed size that tell which hashes were seen twice.

Every task sets the bits of its hashes in a filter of the seen and, for those it
has met twice, in a filter of the twice seen.  The filters of all tasks are merged
segment by segment; a bit that two tasks have set counts as seen twice.  The
result never misses a repeated hash.  Its size is a parameter, so it can be handed
to all tasks; one that is too small for the data only suspects more hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SEGMENTS = 256
_FLUSH = 1_000_000


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For both probes of every hash: its segment and its bit in the segment."""
    segment = (hashes >> np.uint64(56)).astype(np.uint32)
    size = np.uint64(bits)
    probes = [hashes % size, (hashes >> np.uint64(28)) % size]
    return np.tile(segment, 2), np.concatenate(probes).astype(np.uint32)


def _packed(bits_set: np.ndarray, bits: int) -> bytes:
    """Bit numbers as a list, or as the bit map itself where that is smaller."""
    if 32 * len(bits_set) < bits:
        return b"l" + bits_set.astype("<u4").tobytes()
    whole = np.zeros(bits, np.uint8)
    whole[bits_set] = 1
    return b"m" + np.packbits(whole).tobytes()


def _unpacked(data: bytes, bits: int) -> np.ndarray:
    """The bit map, eight bits in a byte."""
    if data[:1] == b"m":
        return np.frombuffer(data, np.uint8, offset=1)
    whole = np.zeros(bits, np.uint8)
    whole[np.frombuffer(data, "<u4", offset=1)] = 1
    return np.packbits(whole)


def _sketch(parts: list[np.ndarray], bits: int) -> pa.RecordBatch:
    hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
    segments, places = _positions(hashes, bits)
    twice = np.tile(counts > 1, 2)
    order = np.argsort(segments, kind="stable")
    segments, places, twice = segments[order], places[order], twice[order]
    edges = np.searchsorted(segments, np.arange(_SEGMENTS + 1))
    filled = [s for s in range(_SEGMENTS) if edges[s] < edges[s + 1]]
    spans = [slice(edges[s], edges[s + 1]) for s in filled]
    once = [_packed(np.unique(places[s]), bits) for s in spans]
    again = [_packed(np.unique(places[s][twice[s]]), bits) for s in spans]
    return pa.RecordBatch.from_arrays(
        [pa.array(filled, pa.int32()), pa.array(once, pa.binary()), pa.array(again, pa.binary())],
        names=["segment", "once", "twice"],
    )


@dataclass(frozen=True)
class TwiceSeen:
    """The merged filter of the twice seen; ``suspects`` tests an array of hashes."""

    segments: np.ndarray

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        segments, places = _positions(hashes, 8 * self.segments.shape[1])
        hit = (self.segments[segments, places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1
        return (hit[: len(hashes)] & hit[len(hashes) :]).astype(bool)


def seen(
    rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], filter_bytes: int
) -> TwiceSeen:
    """A filter of all hashes: as each is put in twice, nothing is missed."""

    def twice(batch):
        for part in hashes(batch):
            yield np.tile(part, 2)

    return twice_seen(rows, twice, filter_bytes)


def twice_seen(
    rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], filter_bytes: int
) -> TwiceSeen:
    """The filter over all hashes (unsigned 64-bit) that ``hashes`` yields for the batches of ``rows``.

    ``filter_bytes`` is a power of two; so many bytes reach the driver, whatever the data.
    """
    bits = filter_bytes * 8 // _SEGMENTS

    def sketch(batches):
        parts, held = [], 0
        for batch in batches:
            for part in hashes(batch):
                parts.append(part)
                held += len(part)
                if held >= _FLUSH:
                    yield _sketch(parts, bits)
                    parts, held = [], 0
        if held:
            yield _sketch(parts, bits)

    def merge(batches):
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                new = _unpacked(once, bits)
                again = _unpacked(twice, bits)
                if segment in seen:
                    known = seen[segment]
                    again = known[1] | again | (known[0] & new)
                    new = known[0] | new
                seen[segment] = [new, again]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(seen), pa.int32()),
                pa.array([again.tobytes() for _, again in seen.values()], pa.binary()),
            ],
            names=["segment", "twice"],
        )

    merged = (
        rows.mapInArrow(sketch, "segment int, once binary, twice binary")
        .repartition("segment")
        .mapInArrow(merge, "segment int, twice binary")
    )
    filled = np.zeros((_SEGMENTS, bits // 8), np.uint8)
    for row in merged.collect():
        filled[row["segment"]] = np.frombuffer(row["twice"], np.uint8)
    return TwiceSeen(filled)

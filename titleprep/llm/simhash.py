"""Near duplicates by SimHash, compared exactly tile by tile.

1. Each document gets a fingerprint of one or more lanes of 64 bits: shingles of words
   (A-Z lower-cased, joined by a space) are hashed with XXH64 (seed 42), repeats
   included; a bit is 1 when it is set in over half of the hashes.  Further lanes mix
   the same hashes again.  No words: fingerprint zero.
2. Distinct fingerprints are grouped by their number of set bits and dealt into
   tiles.  Two fingerprints within ``radius`` bits differ by at most ``radius`` in
   that number, so tile pairs further apart are never made.
3. Each remaining tile pair is compared in full with numpy (exclusive or and bit
   counts).  A tile pair passes on a spanning forest of its links, so a group of
   near copies gives edges in proportion to its size.
4. Components of the forest are found by joins; every document gets the smallest
   document id that it reaches.

How far apart two fingerprints are estimates how similar the sets of shingles are.
One lane and a small radius find texts with few changes; ``for_similarity`` sets a
radius for a share of common shingles, with more lanes for a sharper estimate.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from titleprep.llm.common import free_name, texts, word_lists
from titleprep.llm.components import components
from titleprep.scale import reread

_BITS = 64
_MIX = 0x9E3779B97F4A7C15
_SET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BLOCK = 32
_PARTNERS = 32  # tiles that meet one tile in one place


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    """The hashes of all shingles of ``words``, of which there are at least ``size``."""
    text = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    hash_ = xxhash.xxh64_intdigest
    last = ends[size - 1 :]
    return np.fromiter(
        (hash_(text[a : b - 1], 42) for a, b in zip(starts, last)), np.uint64, len(last)
    )


def mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """The hashes themselves, or for further lanes other numbers that follow from them."""
    if not lane:
        return hashes
    x = hashes + np.uint64(lane * _MIX % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingles(data: bytes, size: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, part by part; of all its words where they are fewer than ``size``."""
    carried, some = [], False
    for words in word_lists(data.lower()):
        words = carried + words
        if len(words) >= size:
            some = True
            yield _hashes(words, size)
            carried = words[len(words) - size + 1 :]
        else:
            carried = words
    if not some and carried:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), 42)], np.uint64)


def print_of(parts: Iterable[np.ndarray], lanes: int) -> list[int]:
    """The lanes of the fingerprint of some hashes as unsigned numbers."""
    counts, total = np.zeros((lanes, _BITS), np.int64), 0
    for hashes in parts:
        total += len(hashes)
        for lane in range(lanes):
            octets = mixed(hashes, lane).astype("<u8").view(np.uint8).reshape(-1, 8)
            for i in range(8):
                counts[lane, 8 * i : 8 * i + 8] += np.bincount(octets[:, i], minlength=256) @ _SET
    return [sum(1 << i for i in np.flatnonzero(2 * own > total).tolist()) for own in counts]


def fingerprint(data: bytes, size: int, lanes: int = 1) -> list[int]:
    """The lanes of a text's fingerprint as unsigned numbers."""
    return print_of(shingles(data, size), lanes)


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``a`` and ``b`` at most ``radius`` bits apart."""
    lanes = a.shape[1]
    # two lanes for all pairs, the others for those that are still near; more where
    # two unrelated lanes would often be within the radius
    first = min(lanes, 2)
    while first < lanes and radius > 32 * first - 10 * math.sqrt(first):
        first += 1
    apart = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0])
    for lane in range(1, first):
        apart = apart + np.bitwise_count(a[:, None, lane] ^ b[None, :, lane])
    i, j = np.nonzero(apart <= radius)
    if lanes > first:
        whole = np.bitwise_count(a[i] ^ b[j]).sum(axis=1, dtype=np.int64) <= radius
        i, j = i[whole], j[whole]
    return i, j


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest between two tiles (or within one), as numbers of rows.

    Rows of ``b`` are numbered after those of ``a``.
    """
    size = len(a)
    count = size if same else size + len(b)
    shift = 0 if same else size
    root = np.arange(count)
    links: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    for at in range(0, size, _BLOCK):
        first = at if same else 0
        i, j = _near(a[at : at + _BLOCK], b[first:], radius)
        i, j = i + at, j + first + shift
        while True:
            # many links lie within one tree already: only one link for each pair of trees is followed
            ri, rj = root[i], root[j]
            apart = ri != rj
            if not apart.any():
                break
            i, j, ri, rj = i[apart], j[apart], ri[apart], rj[apart]
            _, one = np.unique(np.minimum(ri, rj) * count + np.maximum(ri, rj), return_index=True)
            for k in one.tolist():
                x, y = find(int(i[k])), find(int(j[k]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((int(i[k]), int(j[k])))
            while (root != root[root]).any():
                root = root[root]
    return links


def least_ids(prints: DataFrame, roots: DataFrame) -> DataFrame:
    """``(_node, component_id)``: the smallest ``_least`` of each component of ``prints``."""
    grouped = prints.join(roots, prints["_node"] == roots["node"], "left").select(
        "_node", "_least", F.coalesce("root", "_node").alias("_root")
    )
    least = grouped.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return reread(grouped.join(least, "_root").select("_node", "component_id"))


def least_of_each(docs: DataFrame, grouped: DataFrame, id_col: str) -> DataFrame:
    """The documents whose id is that of their component in ``grouped``."""
    found = grouped.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    name = free_name(docs, "_kept")
    kept = found.select(F.col(id_col).alias(name)).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")


@dataclass(frozen=True)
class SimHashDedup:
    """``shingle`` words, ``lanes`` of 64 bits, ``radius`` differing bits, about ``tile`` fingerprints in a tile.

    Null, empty and blank text has fingerprint zero and is linked like any other.
    Equal texts share a fingerprint and so a component.  Rows that share an id keep
    their own fingerprints; their id may then stand in two components.  Documents
    without an id get the smallest id of their component, null if it has none.  An
    empty table gives an empty table.
    """

    shingle: int = 3
    radius: int = 3
    lanes: int = 1
    tile: int = 16_384
    id_col: str = "doc_id"
    text_col: str = "text"

    @classmethod
    def for_similarity(cls, least: float, shingle: int = 5, lanes: int = 4, **more) -> SimHashDedup:
        """A radius that holds pairs with at least this share of common shingles.

        Two sets with that share differ in each bit with the probability angle / pi.
        The radius is the mean number of such bits and 1.6 deviations more, so that 95 of
        100 pairs right at the limit are linked, and nearly all pairs above it.
        """
        share = math.acos(2 * least / (1 + least)) / math.pi
        bits = _BITS * lanes
        radius = bits * share + 1.6 * math.sqrt(bits * share * (1 - share))
        return cls(shingle=shingle, radius=round(radius), lanes=lanes, **more)

    def fingerprints(self, docs: DataFrame) -> DataFrame:
        """``(id, _lanes, _node)``; the lanes as signed numbers, and one number for the whole."""
        columns = docs.select(self.id_col, self.text_col)
        size, lanes, text_col = self.shingle, self.lanes, self.text_col

        def compute(batches):
            for batch in batches:
                prints = [fingerprint(t, size, lanes) for t in texts(batch, text_col)]
                flat = np.array(prints, np.uint64).reshape(-1, lanes)
                node = flat[:, 0] if lanes == 1 else np.array(
                    [xxhash.xxh3_64_intdigest(row.tobytes()) for row in flat], np.uint64
                )
                ends = pa.array(range(0, lanes * len(flat) + 1, lanes), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.ListArray.from_arrays(ends, pa.array(flat.reshape(-1).view(np.int64))),
                        pa.array(node.view(np.int64)),
                    ],
                    names=[self.id_col, "_lanes", "_node"],
                )

        schema = StructType([columns.schema[self.id_col]]).add("_lanes", ArrayType(LongType())).add("_node", "long")
        return columns.mapInArrow(compute, schema)

    def meetings(self, prints: DataFrame) -> DataFrame:
        """``(_from, _tile, _same)``: two tiles, lists of rows of ``prints``, and whether they are the same one.

        ``prints`` are distinct, with ``_node`` and ``_lanes``; any two within the radius meet once.
        """
        radius, lanes = self.radius, self.lanes
        ones = F.aggregate("_lanes", F.lit(0), lambda n, lane: n + F.bit_count(lane))
        counted = prints.withColumn("_ones", ones)
        sizes = {r["_ones"]: r["count"] for r in counted.groupBy("_ones").count().collect()}  # one per number of bits
        tiles = [-(-sizes.get(n, 0) // self.tile) for n in range(_BITS * lanes + radius + 1)]
        of = F.array(*map(F.lit, tiles))
        dealt = (
            counted.withColumn("_part", F.pmod(F.xxhash64("_node"), F.get(of, F.col("_ones"))).cast("int"))
            .groupBy("_ones", "_part")
            .agg(F.collect_list(F.struct(*prints.columns)).alias("_tile"))
        )
        dealt = reread(dealt)

        def partners(gap):
            least = F.when(gap == 0, F.col("_part")).otherwise(F.lit(0))
            most = F.get(of, F.col("_ones") + gap) - 1
            parts = F.when(most >= least, F.sequence(least, most)).otherwise(F.array().cast("array<int>"))
            return F.transform(
                parts, lambda p: F.struct((F.col("_ones") + gap).alias("_ones"), p.alias("_part"))
            )

        # a tile has more partners on larger inputs: they meet it in several places
        places = max(1, -(-sum(tiles) // _PARTNERS))
        place = F.pmod(F.xxhash64("_ones", "_part"), F.lit(places)).alias("_place")
        gaps = F.sequence(F.lit(0), F.lit(radius))
        left = dealt.select(
            F.explode(F.flatten(F.transform(gaps, partners))).alias("_to"),
            F.col("_ones").alias("_from_ones"),
            F.col("_part").alias("_from_part"),
            F.col("_tile").alias("_from"),
            place,
        ).select("_to._ones", "_to._part", "_place", "_from_ones", "_from_part", "_from")
        right = dealt.withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(places - 1))))
        right = right.withColumn("_place", F.col("_place").cast("long"))
        return left.join(right, ["_ones", "_part", "_place"]).select(
            "_from",
            "_tile",
            ((F.col("_ones") == F.col("_from_ones")) & (F.col("_part") == F.col("_from_part"))).alias("_same"),
        )

    def links(self, prints: DataFrame) -> DataFrame:
        """Edges ``(u, v)`` of nodes that connect all within the radius; ``prints (_node, _lanes)`` are distinct."""
        radius, lanes = self.radius, self.lanes

        def read(tile):
            rows = tile.values
            node = rows.field("_node").to_numpy(zero_copy_only=False)
            flat = rows.field("_lanes").flatten().to_numpy(zero_copy_only=False)
            return node, np.ascontiguousarray(flat.reshape(-1, lanes)).view(np.uint64)

        def compare(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    (a_node, a), (b_node, b) = read(batch.column(0)[k]), read(batch.column(1)[k])
                    same = batch.column(2)[k].as_py()
                    node = a_node if same else np.concatenate([a_node, b_node])
                    ends = node[np.array(_forest(a, b, same, radius), np.int64).reshape(-1, 2)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"]
                    )

        return self.meetings(prints).mapInArrow(compare, "u long, v long")

    def __call__(self, docs: DataFrame) -> DataFrame:
        """``(id, fingerprint, component_id)`` for every document."""
        id_col = self.id_col
        of_docs = reread(self.fingerprints(docs))
        prints = reread(
            of_docs.groupBy("_node").agg(F.first("_lanes").alias("_lanes"), F.min(id_col).alias("_least"))
        )
        named = least_ids(prints, components(self.links(prints.select("_node", "_lanes"))))
        digits = F.transform("_lanes", lambda lane: F.lpad(F.lower(F.hex(lane)), 16, "0"))
        return of_docs.join(named, "_node").select(
            id_col, F.array_join(digits, "").alias("fingerprint"), "component_id"
        )

    def keep_one(self, docs: DataFrame) -> DataFrame:
        """The documents, of each component only the one with the smallest id.

        Where a component has no ids at all, its documents stay.  Rows that share
        the kept id are kept together.
        """
        return least_of_each(docs, self(docs), self.id_col)

"""Removes passages that occur more than once, byte by byte, with run-length indexes.

A byte goes when a string of ``span`` bytes that covers it also starts anywhere
else, in another document or the same.

1. Every string of ``span`` bytes is owned by one anchor: of the ``word``-byte
   strings inside it, the one with the least hash (the last of equals).  Equal
   strings own equal anchors at equal places, so strings have to be compared only
   within the group of an anchor.  Consecutive strings mostly share their anchor and
   make one region, about 1 in 75 bytes starts a new one.
2. Two Bloom filters find the anchors that may occur twice; only their regions leave
   the task, as digests.  A region that occurs twice as a whole needs no closer look,
   nor does an anchor with one region.
3. What is left is fetched from the texts, one copy of each region.  Whole groups of
   an anchor are put together in batches, a batch is indexed by a run-compressed
   Burrows-Wheeler transform, and each place's longest match elsewhere is read off the
   samples at the ends of runs (``run_index``).  A group with more than ``group``
   different regions is not given to one task: its strings are counted by digest.
4. The marks go back to the texts and the bytes are removed.

Equal texts are handled once in each batch.  Only texts that are needed, by a Bloom
filter of their digests, are shuffled; the others are read and passed on.
"""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from titleprep.llm.common import slices
from titleprep.llm.common import texts as texts_of
from titleprep.llm.run_index import RunIndex
from titleprep.llm.twice_seen import TwiceSeen, seen, twice_seen
from titleprep.scale import reread

_BUFFER = 1 << 17
_PLACE_BITS = 18
_BASE = 0x9E3779B97F4A7C15
_BATCH_BYTES = 1 << 20


@functools.lru_cache(maxsize=2)
def _powers(base: int) -> np.ndarray:
    """Powers of ``base`` modulo 2**64 for a whole buffer."""
    out = np.ones(1 << _PLACE_BITS, np.uint64)
    known = 1
    while known < len(out):
        out[known : 2 * known] = out[:known] * np.uint64(pow(base, known, 1 << 64))
        known *= 2
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def _buffers(texts: list[bytes], span: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts put together up to the size of a buffer; longer ones in overlapping parts."""
    parts, held = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(len(text) - span + 1, 0), _BUFFER - span + 1):
            part = text[at : at + _BUFFER]
            if held + len(part) > _BUFFER and parts:
                yield parts
                parts, held = [], 0
            parts.append((number, at, part))
            held += len(part)
    if parts:
        yield parts


def regions(texts: list[bytes], span: int, word: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Text number, first string, strings, anchor's place after the first, anchor's hash."""
    forward, backward = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
    window = span - word + 1
    low = np.uint64((1 << _PLACE_BITS) - 1)
    for parts in _buffers(texts, span):
        data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        sizes = np.array([len(p) for _, _, p in parts])
        offsets = np.cumsum(sizes) - sizes
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * forward[: len(data)], out=sums[1:])
        count = len(data) - word + 1
        hashes = _mixed((sums[word:] - sums[:-word]) * backward[:count])
        # the place stands in the low bits, so that the last of equals is the least
        least = (hashes & ~low) | (low - np.arange(count, dtype=np.uint64))
        width = 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < window:
            least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
        inside = np.zeros(len(data) + 1, np.int8)
        inside[offsets] += 1
        np.add.at(inside, offsets + sizes - span + 1, -1)
        starts = np.flatnonzero(np.cumsum(inside[: len(least)]))
        anchor = (low - (least[starts] & low)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        begin, anchor = starts[first], anchor[first]
        strings = np.diff(np.append(first, len(starts)))
        part = np.searchsorted(offsets, begin, "right") - 1
        number = np.array([n for n, _, _ in parts])[part]
        moved = np.array([at for _, at, _ in parts])[part] - offsets[part]
        yield number, begin + moved, strings, anchor - begin, hashes[anchor]


def _different(texts: list[bytes]) -> dict[bytes, list[int]]:
    """Rows by the digest of their text."""
    rows = defaultdict(list)
    for row, text in enumerate(texts):
        rows[xxhash.xxh3_128_digest(text)].append(row)
    return rows


def _numbers(digests: list[bytes]) -> np.ndarray:
    """The first half of 16-byte digests as numbers."""
    return np.frombuffer(b"".join(digests), "<u8")[::2]


def _filter_of(table: DataFrame, filter_bytes: int) -> Broadcast[TwiceSeen]:
    """All digests in ``_text``."""

    def hashes(batch):
        yield np.unique(_numbers(batch.column(0).to_pylist()))

    return table.sparkSession.sparkContext.broadcast(seen(table.select("_text"), hashes, filter_bytes))


def _shared(group: list[tuple], span: int, word: int) -> list[tuple]:
    """Rows (.., strings, place, region) that have most of a string in common with another one.

    The strings of a region have between 0 and ``span - word`` bytes before the
    anchor; for each eighth of that range they share all bytes but a few.
    """
    room = span - word
    edges = [room * i // 8 for i in range(9)]
    parts = [(edges[i] + (i > 0), edges[i + 1]) for i in range(8)]
    keys = []
    for *_, strings, place, region in group:
        keys.append(
            [
                (i, region[place - fewest : place + span - most])
                for i, (fewest, most) in enumerate(parts)
                if place - strings + 1 <= most and place >= fewest
            ]
        )
    seen = Counter(key for own in keys for key in own)
    return [row for row, own in zip(group, keys) if any(seen[key] > 1 for key in own)]


def _runs(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places of the runs of true."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()


def _grouped(batches) -> Iterator[list[tuple]]:
    """The different regions of each anchor, whose rows come one after the other."""
    group, last = {}, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and row[0] != last:
                yield list(group.values())
                group = {}
            last = row[0]
            # a text that is read in several batches brings its regions again
            group.setdefault(row[1], row)
    if group:
        yield list(group.values())


def _batches(groups: Iterator[list[tuple]], most: int) -> Iterator[list[list[tuple]]]:
    """Groups whose regions have at most ``most`` bytes together, or a single larger group."""
    held, size = [], 0
    for group in groups:
        own = sum(len(row[-1]) for row in group)
        if held and size + own > most:
            yield held
            held, size = [], 0
        held.append(group)
        size += own
    if held:
        yield held


_ANCHORS = "_text binary, h long, d long, first int, strings int, place int, copies int"
_MARKS = "h long, d long, starts array<int>, stops array<int>"


@dataclass(frozen=True)
class RepeatedPassages:
    """``span`` bytes repeat, anchors have ``word``; ``filter_bytes`` for each Bloom filter.

    Null text is empty; a text shorter than ``span`` stays as it is.  Every row is a
    document of its own, so rows that share an id or a text repeat each other.  An
    empty table gives an empty table.  Other columns of the documents are left out.
    """

    span: int = 200
    word: int = 50
    group: int = 8_000
    filter_bytes: int = 16 << 20
    text_filter_bytes: int = 4 << 20
    id_col: str = "doc_id"
    text_col: str = "text"

    def _texts(self, docs: DataFrame, needed: Broadcast[TwiceSeen], inside: bool = True) -> DataFrame:
        """``(_text, _ids, data)``: different texts of each batch with the ids of their rows.

        Those that may be ``needed``, or those that are surely not.
        """
        columns = docs.select(F.col(self.id_col).alias("_id"), F.col(self.text_col).alias("text"))

        def run(batches):
            for batch in slices(batches):
                texts = texts_of(batch, "text")
                rows = _different(texts)
                chosen = needed.value.suspects(_numbers(list(rows))) == inside
                rows = {key: own for (key, own), use in zip(rows.items(), chosen.tolist()) if use}
                ends = np.cumsum([0, *map(len, rows.values())])
                ids = batch.column(0).take(pa.array([i for r in rows.values() for i in r], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(rows), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
                        pa.array([texts[r[0]] for r in rows.values()], pa.binary()),
                    ],
                    names=["_text", "_ids", "data"],
                )

        schema = StructType().add("_text", "binary").add("_ids", ArrayType(columns.schema["_id"].dataType))
        return columns.mapInArrow(run, schema.add("data", "binary"))

    def _anchors(self, docs: DataFrame) -> DataFrame:
        """Regions whose anchor may occur twice, written."""
        column = docs.select(F.col(self.text_col).alias("text"))
        span, word = self.span, self.word

        def hashes(batch):
            texts = texts_of(batch, "text")
            rows = list(_different(texts).values())
            several = np.array([len(r) > 1 for r in rows], bool)
            for number, *_, found in regions([texts[r[0]] for r in rows], span, word):
                # the least hashes are chosen, so their high bits are alike: mixed again
                own = _mixed(found)
                yield own
                yield own[several[number]]

        seen = twice_seen(column, hashes, self.filter_bytes)
        shared = docs.sparkSession.sparkContext.broadcast(seen)

        def run(batches):
            for batch in slices(batches):
                texts = texts_of(batch, "text")
                rows = _different(texts)
                digests, places = list(rows), list(rows.values())
                chosen = [texts[r[0]] for r in places]
                for number, first, strings, place, found in regions(chosen, span, word):
                    hit = shared.value.suspects(_mixed(found))
                    columns = [c[hit].tolist() for c in (number, first, strings, place)]
                    digest = [
                        xxhash.xxh3_64_intdigest(chosen[n][f : f + s + span - 1], p)
                        for n, f, s, p in zip(*columns)
                    ]
                    number, first, strings, place = columns
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([digests[n] for n in number], pa.binary()),
                            pa.array(found[hit].view(np.int64)),
                            pa.array(np.array(digest, np.uint64).view(np.int64)),
                            pa.array(first, pa.int32()),
                            pa.array(strings, pa.int32()),
                            pa.array(place, pa.int32()),
                            pa.array([min(len(places[n]), 2) for n in number], pa.int32()),
                        ],
                        names=["_text", "h", "d", "first", "strings", "place", "copies"],
                    )

        anchors = reread(column.mapInArrow(run, _ANCHORS))
        # the table is written: workers need not hold the filter during the steps that follow
        shared.destroy()
        return anchors

    def _fetched(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """``(h, d, copies, strings, place, region)`` for ``wanted``, read from the texts."""
        by_text = wanted.groupBy("_text").agg(
            F.collect_list(F.struct("h", "d", "copies", "strings", "place", "first")).alias("_wanted")
        )
        span = self.span
        needed = _filter_of(wanted, self.text_filter_bytes)
        texts = self._texts(docs, needed).select("_text", "data")
        joined = texts.join(by_text, "_text").select("data", "_wanted")

        def run(batches):
            for batch in slices(batches):
                rows = []
                for data, wanted in zip(batch.column(0), batch.column(1)):
                    data = data.as_py()
                    for w in wanted.as_py():
                        region = data[w["first"] : w["first"] + w["strings"] + span - 1]
                        rows.append((w["h"], w["d"], w["copies"], w["strings"], w["place"], region))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                columns = zip(*rows) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["h", "d", "copies", "strings", "place", "region"],
                )

        return joined.mapInArrow(
            run, "h long, d long, copies long, strings int, place int, region binary"
        )

    def _indexed(self, fetched: DataFrame) -> DataFrame:
        """Marks of regions that match others of their group, by run-length indexes."""
        span, word = self.span, self.word

        def marks(groups):
            rows = [row for group in groups for row in _shared(group, span, word)]
            if not rows:
                return []
            found = RunIndex([row[-1] for row in rows]).matches()
            out = []
            for (h, d, copies, strings, _, _), longest in zip(rows, found):
                hit = longest[:strings] >= span
                if copies == 1 and hit.any():
                    out.append((h, d, *_runs(hit)))
            return out

        def batch_of(rows):
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            columns = zip(*rows) if rows else [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["h", "d", "starts", "stops"]
            )

        def run(batches):
            for groups in _batches(_grouped(batches), _BATCH_BYTES):
                yield batch_of(marks(groups))

        return fetched.repartition("h").sortWithinPartitions("h").mapInArrow(run, _MARKS)

    def _counted(self, fetched: DataFrame) -> DataFrame:
        """The same marks for large groups, by counting digests of their strings."""
        span = self.span

        def run(batches):
            for batch in batches:
                for h, d, copies, strings, _, region in zip(*(c.to_pylist() for c in batch.columns)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(
                                [xxhash.xxh3_128_digest(region[i : i + span]) for i in range(strings)],
                                pa.binary(),
                            ),
                            pa.array([h] * strings, pa.int64()),
                            pa.array([d] * strings, pa.int64()),
                            pa.array([copies] * strings, pa.int64()),
                            pa.array(range(strings), pa.int32()),
                        ],
                        names=["string", "h", "d", "copies", "start"],
                    )

        strings = reread(
            fetched.mapInArrow(run, "string binary, h long, d long, copies long, start int")
        )
        repeated = (
            strings.groupBy("string")
            .agg(F.min("d").alias("_one"), F.max("d").alias("_other"))
            .where("_one <> _other")
            .select("string")
        )
        starts = F.array_sort(F.collect_set("start"))
        return (
            strings.where("copies = 1")
            .join(repeated, "string")
            .groupBy("h", "d")
            .agg(starts.alias("starts"), starts.alias("stops"))
        )

    def marks(self, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Regions that may be repeated, and ``(h, d, starts, stops)``: the strings that are."""
        anchors = self._anchors(docs)
        row = F.struct("_text", "first", "strings", "place")
        grouped = reread(
            anchors.groupBy("h", "d").agg(F.sum("copies").alias("copies"), F.min(row).alias("_row"))
        )
        sizes = grouped.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        largest = sizes.agg(F.max("_n")).first()[0] or 0
        open_ = reread(grouped.join(sizes, "h").select("h", "d", "copies", "_n", "_row.*"))
        found = self._indexed(self._fetched(docs, open_.where(F.col("_n") <= self.group)))
        if largest > self.group:
            large = self._fetched(docs, open_.where(F.col("_n") > self.group))
            found = found.union(self._counted(large))
        whole = grouped.where("copies > 1").select(
            "h",
            "d",
            F.array(F.lit(0)).alias("starts"),
            F.array(F.col("_row.strings") - 1).alias("stops"),
        )
        return anchors, whole.union(found)

    def __call__(self, docs: DataFrame) -> DataFrame:
        """``(id, n_bytes, n_removed, n_spans, kept)`` for every document; ``kept`` are its bytes."""
        anchors, marks = self.marks(docs)
        by_text = reread(
            anchors.join(marks, ["h", "d"])
            .groupBy("_text")
            .agg(F.collect_set(F.struct("first", "starts", "stops")).alias("_marks"))
        )
        span = self.span
        needed = _filter_of(by_text, self.text_filter_bytes)
        marked = self._texts(docs, needed).join(by_text, "_text", "left").select("_ids", "data", "_marks")
        clean = self._texts(docs, needed, inside=False).select("_ids", "data")
        joined = marked.unionByName(clean, allowMissingColumns=True)

        def run(batches):
            for batch in slices(batches):
                rows = []
                for data, marks in zip(batch.column(1), batch.column(2)):
                    data = data.as_py()
                    edge = np.zeros(len(data) + 1, np.int32)
                    for mark in marks.as_py() or ():
                        begin = mark["first"] + np.array(mark["starts"])
                        end = mark["first"] + np.array(mark["stops"]) + span
                        np.add.at(edge, begin, 1)
                        np.add.at(edge, end, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    rows.append((len(data), len(data) - len(kept), len(_runs(gone)[0]), kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = zip(*rows) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    names=["_ids", "n_bytes", "n_removed", "n_spans", "kept"],
                )

        schema = StructType([joined.schema["_ids"]])
        for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary")):
            schema = schema.add(name, kind)
        done = joined.mapInArrow(run, schema)
        return done.select(
            F.explode("_ids").alias(self.id_col), "n_bytes", "n_removed", "n_spans", "kept"
        )

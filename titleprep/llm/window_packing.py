"""Packs documents into windows of a fixed number of tokens, best fit first, longest first.

1. Texts are encoded in the tasks that read them; a document ends with an extra id.
   Documents longer than a window are first cut into full windows and a rest.
2. The number of pieces of each length, at most ``capacity`` numbers, is all that
   best-fit decreasing needs (``windows``): a segment tree over remaining capacity
   finds the tightest open window for whole groups of equal pieces at a time.
3. Every piece gets its rank among the pieces of its length: the rank inside its
   task and the number of such pieces in the tasks before.  The rank is looked up
   in the layout, whose size is bounded by the number of lengths.
4. Windows that best fit leaves partly empty would be padded.  The fullest of them
   are filled up with pieces of the emptiest, which are cut where a window is full;
   only these pieces are cut, and only their ids are read again.
"""

from __future__ import annotations

import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from titleprep.llm.byte_tokens import byte_tokens
from titleprep.llm.windows import RANKS, layout
from titleprep.scale import lookup, reread, store


def _gathered(made, rows: int = 256):
    """Small batches put together."""
    while part := list(itertools.islice(made, rows)):
        yield pa.Table.from_batches(part).combine_chunks().to_batches()[0]


@dataclass(frozen=True)
class WindowPacking:
    """Packs all documents; ``tokenizer`` is the path of a byte-level ``tokenizers`` file.

    Null and empty texts are documents of the end id alone.  Documents without an
    id and rows that share an id are packed like any other, each row for itself.
    Very long texts are cut into windows; a text of n tokens takes some 6 n bytes of
    a task while it is encoded.  An empty table gives an empty table.  Other columns
    of the documents are left out.  Sequences are full or, fewer than the bits of
    ``capacity`` of them and those that best fit leaves so, a power of two long.
    """

    tokenizer: str
    capacity: int = 2_048
    end_id: int = 1
    id_col: str = "doc_id"
    text_col: str = "text"

    def pieces(self, docs: DataFrame) -> DataFrame:
        """``(id, start, length, ids, ids_crc32, doc_tokens, _task, _nth)``.

        ``ids`` are little-endian unsigned numbers of ``length`` times two or four
        bytes, null for full windows, which are never cut again.
        """
        columns = docs.select(self.id_col, self.text_col)
        path, capacity, end_id, id_col = self.tokenizer, self.capacity, self.end_id, self.id_col

        def encode(batches):
            encoder = byte_tokens(path)
            width = "<u2" if max(encoder.ids, end_id + 1) <= 1 << 16 else "<u4"
            task, counted = TaskContext.get().partitionId(), {}
            for batch in batches:
                for row, text in enumerate(batch.column(1)):
                    ids = np.append(encoder.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                    starts = range(0, len(ids), capacity)
                    cuts = [ids[at : at + capacity] for at in starts]
                    nth = []
                    for cut in cuts:
                        nth.append(counted.get(len(cut), 0))
                        counted[len(cut)] = nth[-1] + 1
                    k = len(cuts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(batch.column(0)[row], k),
                            pa.array(starts, pa.int64()),
                            pa.array([len(c) for c in cuts], pa.int64()),
                            pa.array([c.astype(width).tobytes() if len(c) < capacity else None for c in cuts], pa.binary()),
                            pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                            pa.array([len(ids)] * k, pa.int64()),
                            pa.array([task] * k, pa.int32()),
                            pa.array(nth, pa.int64()),
                        ],
                        names=[id_col, "start", "length", "ids", "ids_crc32", "doc_tokens", "_task", "_nth"],
                    )

        schema = StructType([columns.schema[id_col]])
        for name, kind in (
            ("start", "long"),
            ("length", "long"),
            ("ids", "binary"),
            ("ids_crc32", "long"),
            ("doc_tokens", "long"),
            ("_task", "integer"),
            ("_nth", "long"),
        ):
            schema = schema.add(name, kind)
        return columns.mapInArrow(lambda batches: _gathered(encode(batches)), schema)

    def _ranked(self, pieces: DataFrame) -> DataFrame:
        before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
        first = (
            pieces.groupBy("_task", "length")
            .agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .drop("_n")
        )
        found = lookup(pieces, [store(first)], ["_task", "length"], even=True)
        return found.withColumn("_rank", F.col("_nth") + F.col("_first")).drop("_task", "_nth", "_first")

    def place(self, pieces: DataFrame) -> DataFrame:
        """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``; ``pieces`` is a written table."""
        counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
        plan = layout(counts, self.capacity)
        spark = pieces.sparkSession
        slots, gaps = spark.sparkContext.broadcast(plan.slots), spark.sparkContext.broadcast(plan.gaps)
        kept = [self.id_col, "start", "length", "ids_crc32", "doc_tokens"]
        schema = StructType([pieces.schema[c] for c in kept]).add("sequence_id", "long").add("offset", "long")

        def found(batch):
            known = slots.value
            length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            row = np.searchsorted(known["key"], length * RANKS + rank, "right") - 1
            window, nth = np.divmod(length * RANKS + rank - known["key"][row], known["times"][row])
            inside = nth * length
            stream = known["stream"][row]
            return (
                known["window"][row] + window,
                known["place"][row] + inside,
                np.where(stream < 0, -1, stream + window * known["used"][row] + inside),
            )

        def whole(batches):
            for batch in batches:
                window, place, _ = found(batch)
                columns = [batch[c] for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(window), pa.array(place)], names=schema.names)

        def cut(batches):
            open_ = gaps.value
            for batch in batches:
                window, place, stream = found(batch)
                taken = {name: [] for name in ("row", "start", "length", "ids_crc32", "sequence_id", "offset")}
                start, length, crc = (batch[c].to_numpy() for c in ("start", "length", "ids_crc32"))
                for row in range(batch.num_rows):
                    if stream[row] < 0:
                        parts = [(0, int(length[row]), int(window[row]), int(place[row]))]
                    else:
                        parts = list(_cuts(int(stream[row]), int(length[row]), open_))
                    for at, n, sequence, offset in parts:
                        check = int(crc[row])
                        if n < length[row]:
                            data = batch["ids"][row].as_py()
                            ids = np.frombuffer(data, f"<u{len(data) // int(length[row])}")[at : at + n]
                            check = zlib.crc32(ids.astype("<u4"))
                        values = (row, int(start[row]) + at, n, check, sequence, offset)
                        for column, value in zip(taken.values(), values):
                            column.append(value)
                rows = pa.array(taken.pop("row"), pa.int64())
                columns = {c: batch[c].take(rows) for c in (self.id_col, "doc_tokens")}
                columns |= {c: pa.array(v, pa.int64()) for c, v in taken.items()}
                yield pa.RecordBatch.from_arrays([columns[c] for c in schema.names], names=schema.names)

        ranked = self._ranked(pieces)
        may_be_cut = F.col("length").isin(plan.cut_lengths) if plan.cut_lengths else F.lit(False)
        kept_whole = ranked.where(~may_be_cut).select(*kept, "_rank").mapInArrow(whole, schema)
        if not plan.cut_lengths:
            return kept_whole
        return kept_whole.unionAll(ranked.where(may_be_cut).select(*kept, "ids", "_rank").mapInArrow(cut, schema))

    def __call__(self, docs: DataFrame) -> DataFrame:
        return self.place(reread(self.pieces(docs)))


def _cuts(stream: int, length: int, gaps: dict[str, np.ndarray]):
    """Parts of an item at a place of the stream: (start in the item, length, window, offset)."""
    at = 0
    row = int(np.searchsorted(gaps["stream"], stream, "right")) - 1
    while at < length:
        if row + 1 < len(gaps["stream"]) and gaps["stream"][row + 1] <= stream + at:
            row += 1
        gap = int(gaps["gap"][row])
        nth, inside = divmod(stream + at - int(gaps["stream"][row]), gap)
        n = min(length - at, gap - inside)
        yield at, n, int(gaps["window"][row]) + nth, int(gaps["used"][row]) + inside
        at += n

"""Packs documents into sequences of a fixed number of tokens.

1. Texts are encoded in the tasks that read them; a document ends with an extra id
   and only documents longer than a sequence are cut.
2. The number of pieces of each length, at most ``capacity`` numbers, is all that
   the packing needs (``fillings``).  It gives fillings and how many sequences use
   each.
3. Every piece gets its rank among the pieces of its length: the rank inside its
   task and the number of such pieces in the tasks before.  The rank is looked up
   in the table of fillings, whose size is bounded by the number of lengths.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from titleprep.llm.fillings import Filling, pack
from titleprep.llm.word_tokens import word_tokens
from titleprep.scale import reread

_RANKS = 1 << 40


def slots(fillings: list[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """For each length and run of ranks: the first sequence, pieces in each, place of the first."""
    rows, taken, sequence = [], {}, 0
    for filling, bins in fillings:
        place = 0
        for size, times in filling:
            start = taken.get(size, 0)
            rows.append((size * _RANKS + start, sequence, times, place))
            taken[size] = start + bins * times
            place += size * times
        sequence += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("key", "sequence", "times", "place"), table.T.copy()))


@dataclass(frozen=True)
class BestFitPacking:
    """Packs all documents; ``tokenizer`` is the path of a ``tokenizers`` file.

    Null and empty texts are documents of the end id alone.  Documents without an
    id and rows that share an id are packed like any other, each row for itself.
    An empty table gives an empty table.  Other columns of the documents are left
    out.
    """

    tokenizer: str
    capacity: int = 4_096
    end_id: int = 1
    id_col: str = "doc_id"
    text_col: str = "text"

    def pieces(self, docs: DataFrame) -> DataFrame:
        """``(id, piece, start, length, ids, _task, _nth)``; ids are little-endian unsigned 32-bit numbers."""
        columns = docs.select(self.id_col, self.text_col)
        path, capacity, id_col = self.tokenizer, self.capacity, self.id_col
        end = np.array([self.end_id], "<u4").tobytes()

        def encode(batches):
            encoder = word_tokens(path)
            task, counted = TaskContext.get().partitionId(), {}
            for batch in batches:
                for row, text in enumerate(batch.column(1)):
                    data = encoder.encode(text.as_py() or "") + end
                    size = 4 * capacity
                    cuts = [data[at : at + size] for at in range(0, len(data), size)]
                    lengths = [len(c) // 4 for c in cuts]
                    nth = []
                    for n in lengths:
                        nth.append(counted.get(n, 0))
                        counted[n] = nth[-1] + 1
                    k = len(cuts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(batch.column(0)[row], k),
                            pa.array(range(k), pa.int32()),
                            pa.array(range(0, k * capacity, capacity), pa.int64()),
                            pa.array(lengths, pa.int64()),
                            pa.array(cuts, pa.binary()),
                            pa.array([task] * k, pa.int32()),
                            pa.array(nth, pa.int64()),
                        ],
                        names=[id_col, "piece", "start", "length", "ids", "_task", "_nth"],
                    )

        schema = StructType([columns.schema[id_col]])
        for name, kind in (
            ("piece", "integer"),
            ("start", "long"),
            ("length", "long"),
            ("ids", "binary"),
            ("_task", "integer"),
            ("_nth", "long"),
        ):
            schema = schema.add(name, kind)
        return columns.mapInArrow(_gathered(encode), schema)

    def place(self, pieces: DataFrame) -> DataFrame:
        """Pieces with ``sequence_id`` and ``offset``; ``pieces`` is a written table."""
        counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
        table = pieces.sparkSession.sparkContext.broadcast(slots(pack(counts, self.capacity)))
        before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
        first = (
            pieces.groupBy("_task", "length")
            .agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .drop("_n")
        )
        ranked = pieces.join(first, ["_task", "length"]).withColumn("_rank", F.col("_nth") + F.col("_first"))
        kept = [c for c in pieces.columns if c not in ("_task", "_nth")]
        ranked = ranked.select(*kept, "_rank")

        def look_up(batches):
            known = table.value
            for batch in batches:
                length = batch.column(batch.schema.get_field_index("length")).to_numpy()
                rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
                row = np.searchsorted(known["key"], length * _RANKS + rank, "right") - 1
                nth = rank - (known["key"][row] - length * _RANKS)
                times = known["times"][row]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-1],
                        pa.array(known["sequence"][row] + nth // times),
                        pa.array(known["place"][row] + nth % times * length),
                    ],
                    names=[*batch.schema.names[:-1], "sequence_id", "offset"],
                )

        schema = StructType([ranked.schema[c] for c in kept]).add("sequence_id", "long").add("offset", "long")
        return ranked.mapInArrow(look_up, schema)

    def __call__(self, docs: DataFrame) -> DataFrame:
        """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` for every piece."""
        pieces = self.pieces(docs).withColumn("ids_crc32", F.crc32("ids"))
        return self.place(
            reread(pieces.select(self.id_col, "piece", "start", "length", "ids_crc32", "_task", "_nth"))
        )

    def sequences(self, docs: DataFrame) -> DataFrame:
        """``(sequence_id, ids)``: the packed sequences themselves."""
        placed = self.place(reread(self.pieces(docs)))
        parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
        joined = F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), ""))
        return placed.groupBy("sequence_id").agg(joined.alias("ids"))


def _gathered(run, rows: int = 256):
    """Small batches of ``run`` put together."""

    def gather(batches):
        made = run(batches)
        while part := list(itertools.islice(made, rows)):
            yield pa.Table.from_batches(part).combine_chunks().to_batches()[0]

    return gather

"""Compresses vectors to codes by product quantisation, with active-entry Lloyd rounds.

A vector is cut into equal parts, each part position has a codebook, and a part is
stored as the number of its nearest entry.  All numbers are integers, so results do not
depend on how rows are dealt to tasks.

1. The first entries are parts of the vectors with the smallest ids.
2. A round assigns every part and replaces each entry by the mean of its parts.  Codes
   and exact distances stay with the vectors in a written table.  Partial sums are made
   inside tasks; only one row per entry and task moves, and codebooks, whose size is
   fixed by the parameters, reach the driver.
3. In the next round a part whose entry did not move compares only the entries that
   did, against its stored distance; other parts look at the whole codebook.  Between
   equally near entries the lower index wins in both cases.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, ShortType, StructType

from titleprep.llm.common import free_name
from titleprep.scale import new_path

_CODES, _DISTANCES = "codes", "distances"
# scaled components beyond this are set to it: squared distances of 8,192 components stay below 2 ** 63
LIMIT = 1 << 24
_ROWS = 4_096


def squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by entries, as integers."""
    top = max((int(np.abs(a).max()) for a in (parts, entries) if a.size), default=0)
    if parts.shape[1] * (2 * top) ** 2 < 1 << 53:
        # all sums are whole numbers that doubles hold exactly
        x, c = parts.astype(np.float64), entries.astype(np.float64)
        found = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        return found.astype(np.int64)
    found = np.empty((len(parts), len(entries)), np.int64)
    for at, entry in enumerate(entries):
        difference = parts - entry
        found[:, at] = (difference * difference).sum(1)
    return found


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to the nearest entry, the lower index of equals."""
    found = squared(parts, entries)
    code = found.argmin(1)
    return code, found[np.arange(len(parts)), code]


def reassigned(
    parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, from the codes and distances of before the entries in ``moved`` changed."""
    code, distance = code.copy(), distance.copy()
    rescan = moved[code]
    if rescan.any():
        code[rescan], distance[rescan] = nearest(parts[rescan], entries)
    active, stay = np.flatnonzero(moved), np.flatnonzero(~rescan)
    if len(active) and len(stay):
        which, found = nearest(parts[stay], entries[active])
        which = active[which]
        # an unmoved entry of lower index than the stored one is no nearer than it and not as near
        better = (found < distance[stay]) | ((found == distance[stay]) & (which < code[stay]))
        code[stay[better]], distance[stay[better]] = which[better], found[better]
    return code, distance


def _dense(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass(frozen=True)
class Codebooks:
    """``entries`` by part, entry and position inside the part."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


@dataclass(frozen=True)
class VectorCodes:
    """Codes of all vectors of a table.

    Rows whose vector is null or holds null, NaN or infinite components are left out.
    Vectors shorter than the longest, or than a multiple of ``parts``, are filled up with
    zeros.  Components beyond +-2**24 after scaling are set to that limit.  The first
    entries come from the ``entries`` smallest different ids, null last; of several rows
    with one id the smallest vector counts.  With fewer ids there are fewer entries.
    Rows with equal ids are all coded.  Without any vector the result is empty.  Other
    columns stay, unless they are named ``codes`` or ``distances``.
    """

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    id_col: str = "vec_id"
    vector_col: str = "embedding"

    def _integers(self, vectors: DataFrame, column: str) -> tuple[DataFrame, int]:
        """Kept rows with ``column``, the scaled components, and their number."""
        vector = F.col(f"`{self.vector_col}`")
        finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
        kept = vectors.where(vector.isNotNull() & finite)
        longest = kept.agg(F.max(F.size(vector))).first()[0]
        width = max(1, -(-(longest or 0) // self.parts)) * self.parts
        scale, source = self.scale, free_name(vectors, "_source")
        rest = [c for c in vectors.columns if c.lower() not in (self.vector_col.lower(), _CODES, _DISTANCES)]
        schema = StructType([vectors.schema[c] for c in rest]).add(column, ArrayType(IntegerType()))

        def convert(batches):
            for batch in batches:
                lists = batch[source]
                numbers = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
                dense = np.zeros((batch.num_rows, width), np.int32)
                dense[np.arange(width) < lengths[:, None]] = np.clip(numbers, -LIMIT, LIMIT).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in rest), _lists(dense)], names=[*rest, column])

        columns = [F.col(f"`{c}`") for c in rest]
        return kept.select(*columns, vector.cast("array<double>").alias(source)).mapInArrow(convert, schema), width

    def _first(self, table: DataFrame, column: str, width: int) -> np.ndarray:
        """The first entries; as many rows as a codebook has entries reach the driver."""
        rows = table.select(F.col(f"`{self.id_col}`").alias("id"), F.col(column).alias("v"))
        smallest = rows.select("id").distinct().orderBy(F.col("id").asc_nulls_last()).limit(self.entries)
        chosen = rows.alias("r").join(F.broadcast(smallest.alias("s")), F.expr("r.id <=> s.id"), "left_semi")
        found = chosen.groupBy("id").agg(F.min("v").alias("v")).orderBy(F.col("id").asc_nulls_last()).collect()
        vectors = np.array([r["v"] for r in found], np.int64).reshape(len(found), self.parts, width // self.parts)
        return vectors.transpose(1, 0, 2)

    def _assigned(self, table: DataFrame, vector: str, width: int, entries, moved) -> DataFrame:
        """``table`` with codes and distances; ``moved`` is None in the first round."""
        context, parts = table.sparkSession.sparkContext, self.parts
        books = context.broadcast((entries, moved))
        rest = [c for c in table.columns if c not in (_CODES, _DISTANCES)]
        schema = StructType([table.schema[c] for c in rest])
        schema = schema.add(_CODES, ArrayType(ShortType())).add(_DISTANCES, ArrayType(LongType()))

        def assign(batches):
            entries, moved = books.value
            for whole in batches:
                for at in range(0, whole.num_rows, _ROWS):
                    batch = whole.slice(at, _ROWS)
                    n = batch.num_rows
                    data = _dense(batch[vector], width).astype(np.int64).reshape(n, parts, -1)
                    codes, far = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
                    if moved is not None:
                        before, known = (_dense(batch[c], parts).astype(np.int64) for c in (_CODES, _DISTANCES))
                    for p in range(parts):
                        if moved is None:
                            codes[:, p], far[:, p] = nearest(data[:, p], entries[p])
                        else:
                            codes[:, p], far[:, p] = reassigned(data[:, p], entries[p], moved[p], before[:, p], known[:, p])
                    columns = [*(batch[c] for c in rest), _lists(codes.astype(np.int16)), _lists(far)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*rest, _CODES, _DISTANCES])

        return table.mapInArrow(assign, schema)

    def _means(self, table: DataFrame, vector: str, entries: np.ndarray) -> np.ndarray:
        """The codebooks after a round: floors of the means, unused entries as they were."""
        parts, many, size = entries.shape

        def add(batches):
            sums, counts = np.zeros((parts, many, size), np.int64), np.zeros((parts, many), np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                data = _dense(batch[vector], parts * size).reshape(-1, parts, size)
                codes = _dense(batch[_CODES], parts)
                for p in range(parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    used, first, number = np.unique(codes[order, p], return_index=True, return_counts=True)
                    sums[p, used] += np.add.reduceat(data[order, p].astype(np.int64), first)
                    counts[p, used] += number
            part, entry = np.nonzero(counts)
            columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry])]
            columns += [pa.array(np.ascontiguousarray(sums[part, entry, k])) for k in range(size)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", *names])

        names = [f"s{k}" for k in range(size)]
        schema = "part int, entry int, n long" + "".join(f", {name} long" for name in names)
        sums = table.select(vector, _CODES).mapInArrow(add, schema).groupBy("part", "entry")
        found = entries.copy()
        for row in sums.agg(*[F.sum(name).alias(name) for name in ("n", *names)]).collect():
            found[row["part"], row["entry"]] = [row[name] // row["n"] for name in names]
        return found

    def fit(self, vectors: DataFrame) -> tuple[DataFrame, Codebooks]:
        """The kept rows with ``codes`` and ``distances`` by part, and the codebooks they refer to."""
        spark, vector = vectors.sparkSession, free_name(vectors, "_vector")
        integers, width = self._integers(vectors, vector)
        table, path = _written(integers)
        entries, moved = self._first(table, vector, width), None
        for left in range(self.rounds, -1, -1):
            assigned = self._assigned(table, vector, width, entries, moved)
            if not left:
                assigned = assigned.drop(vector)
            before, (table, path) = path, _written(assigned)
            _delete(spark, before)
            if left:
                means = self._means(table, vector, entries)
                moved, entries = (means != entries).any(2), means
        return table, Codebooks(entries)

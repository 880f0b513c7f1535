"""Small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# the white space that the operators on words and lines know; bytes.split() and bytes.strip() use the same
_GAP = re.compile(rb"[\x20\x09-\x0d]")
_PIECE = 1 << 20


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows``, so that little is held in Python at a time.

    What earlier batches took goes back to the system, not to the next task of the worker only.
    """
    pool = pa.default_memory_pool()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pool.release_unused()


def word_lists(data: bytes, size: int = _PIECE) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size, cut only at white space."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            gap = _GAP.search(data, end)
            end = gap.start() if gap else len(data)
        words = data[at:end].split()
        if words:
            yield words
        at = end


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """``batch`` with columns replaced or added, in the order of ``schema``."""
    arrays = [
        columns[f.name] if f.name in columns else batch.column(batch.schema.get_field_index(f.name))
        for f in schema
    ]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def add_columns(
    df: DataFrame,
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    new: StructType,
    rows: int = 1_000,
) -> DataFrame:
    """``df`` with the columns that ``compute`` derives from Arrow batches of at most ``rows``.

    A column of ``df`` that has the name of a new one, in whatever case, is replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = {name.lower() for name in new.fieldNames()}
    target = StructType([f for f in df.schema.fields if f.name.lower() not in names] + new.fields)
    arrow = to_arrow_schema(target, prefers_large_types=False)

    def run(batches):
        for batch in slices(batches, rows):
            yield with_columns(batch, compute(batch), arrow)

    return df.mapInArrow(run, target)

"""Line deduplication with two Bloom filters.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its ends,
A-Z lower-cased.  A key of at least ``min_chars`` code points that is found in at
least ``min_docs`` documents loses all its lines except those of the largest
document id that holds it.

1. Every task hashes the keys of its documents and sets their bits in two Bloom
   filters: seen, and seen in two documents.  The filters of the tasks are merged
   segment by segment; a bit that two tasks have set counts as seen twice.
2. The filter of the twice seen, whose size is a parameter and never grows with
   the data, goes to all tasks.  Only keys that it suspects leave their task, as
   (document id, 16-byte digest): once to be counted exactly, with partial counts
   before the shuffle, and once to learn which documents must drop them.
3. The documents are joined with what they must drop and rewritten.

A filter that is too small for the data suspects more keys, never fewer, so it
costs shuffled digests and no correctness.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from titleprep.llm.common import add_columns, free_name, texts
from titleprep.llm.twice_seen import twice_seen
from titleprep.scale import lookup, reread, store

_SPACE = b" \t\n\x0b\x0c\r"
_hash = xxhash.xxh3_64_intdigest
_digest = xxhash.xxh3_128_digest


def _long_enough(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars:
        return False
    # only a key that is short in bytes can be too short in code points
    return len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars


def _keys(data: bytes, min_chars: int) -> set[bytes]:
    found = {line.strip(_SPACE) for line in data.lower().split(b"\n")}
    return {key for key in found if _long_enough(key, min_chars)}


@dataclass(frozen=True)
class LineDedup:
    """``filter_bytes`` is the size of each of the two filters (a power of two).

    The columns of the documents stay; ``text`` holds the kept lines joined by a
    line feed, ``n_lines`` the number of lines before and ``n_dropped`` of those
    dropped (columns that had these names are replaced).  Null or empty text is
    one empty line; a document with a null id counts as a document but holds a
    key as the largest id only if no holder has an id.  Rows that share an id are
    documents of their own and are kept or dropped alike.  An empty table gives
    an empty table.
    """

    min_chars: int = 20
    min_docs: int = 3
    filter_bytes: int = 16 << 20
    id_col: str = "doc_id"
    text_col: str = "text"

    def suspects(self, docs: DataFrame) -> DataFrame:
        """``(id, key)`` of all keys that may be in two documents or more, once per document."""
        min_chars, text_col = self.min_chars, self.text_col
        columns = docs.select(F.col(self.id_col).alias("_id"), F.col(text_col))

        def hashes(batch):
            for data in texts(batch, text_col):
                keys = _keys(data, min_chars)
                yield np.fromiter((_hash(k) for k in keys), np.uint64, len(keys))

        seen = twice_seen(columns, hashes, self.filter_bytes)
        shared = docs.sparkSession.sparkContext.broadcast(seen)

        def test(batches):
            for batch in batches:
                ids, found = [], []
                for at, data in enumerate(texts(batch, text_col)):
                    keys = list(_keys(data, min_chars))
                    hit = shared.value.suspects(np.fromiter((_hash(k) for k in keys), np.uint64, len(keys)))
                    chosen = np.flatnonzero(hit).tolist()
                    ids.extend([at] * len(chosen))
                    found.extend(_digest(keys[i]) for i in chosen)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(ids, pa.int64())),
                        pa.array(found, pa.binary()),
                    ],
                    names=["_id", "_key"],
                )

        schema = StructType([columns.schema["_id"]]).add("_key", "binary")
        return columns.mapInArrow(test, schema)

    def drops(self, docs: DataFrame) -> DataFrame:
        """``(id, keys)``: what each document must drop."""
        suspects = reread(self.suspects(docs))
        repeated = store(
            suspects.groupBy("_key")
            .agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_keeper"))
            .where(F.col("_n") >= self.min_docs)
        )
        return (
            lookup(suspects, [repeated], ["_key"], copies=True)
            .where(F.col("_n").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keeper")))
            .groupBy("_id")
            .agg(F.collect_set("_key").alias("_drop"))
        )

    def __call__(self, docs: DataFrame) -> DataFrame:
        text_col, min_chars = self.text_col, self.min_chars
        drop_id, drop = free_name(docs, "_drop_id"), free_name(docs, "_drop")
        drops = self.drops(docs).select(F.col("_id").alias(drop_id), F.col("_drop").alias(drop))
        joined = docs.join(drops, F.col(self.id_col).eqNullSafe(F.col(drop_id)), "left").drop(drop_id)

        def rewrite(batch):
            kept, lines_before, dropped = [], [], []
            drops = batch.column(batch.schema.get_field_index(drop)).to_pylist()
            for data, dropped_keys in zip(texts(batch, text_col), drops):
                lines = data.split(b"\n")
                lines_before.append(len(lines))
                if dropped_keys:
                    gone = set(dropped_keys)
                    keys = [k.strip(_SPACE) for k in data.lower().split(b"\n")]
                    lines = [
                        line
                        for line, key in zip(lines, keys)
                        if not (_long_enough(key, min_chars) and _digest(key) in gone)
                    ]
                kept.append(b"\n".join(lines))
                dropped.append(lines_before[-1] - len(lines))
            return {
                text_col: pa.array(kept, pa.binary()).cast(pa.string()),
                "n_lines": pa.array(lines_before, pa.int64()),
                "n_dropped": pa.array(dropped, pa.int64()),
            }

        new = StructType(
            [
                StructField(text_col, StringType()),
                StructField("n_lines", LongType()),
                StructField("n_dropped", LongType()),
            ]
        )
        return add_columns(joined, rewrite, new).drop(drop)

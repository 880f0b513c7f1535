"""Files whose records may hold their own separator, read by many tasks each.

A text is cut at every separator by Spark's text source, whatever stands around it.
Where a separator lies inside quotes, the pieces belong together.  Counting quotes per
range of a file, natively and with one row per range, tells which ranges begin inside
quotes; then every range puts its own pieces together, in the order of the file, and
only the first and last piece of a range may have to meet those of its neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titleprep import scale

# a record, the end of one, the beginning of one, a range that is all inside one
WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3
_RANGE = ("file", "start")


@dataclass(frozen=True)
class Separated:
    """How records are separated; ``escapes`` matches what hides a quote, ``valid`` a record of several pieces."""

    separator: str
    escapes: str | None = None
    valid: str | None = None

    def odd(self, column: Column) -> Column:
        """Whether a piece has an odd number of quotes."""
        text = F.regexp_replace(column, self.escapes, "") if self.escapes else column
        return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1


# fields of a line are quoted as a whole or not at all
CSV = Separated("\n", valid=r'(?:"(?:[^"]|"")*"|[^",\r\n]*)(?:,(?:"(?:[^"]|"")*"|[^",\r\n]*))*\r?')
JSON_MEMBERS = Separated(",", escapes=r"\\.")


def _pieces(spark: SparkSession, files: Sequence[str], form: Separated) -> DataFrame:
    text = spark.read.option("lineSep", form.separator).text(list(files))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _inside_quotes(pieces: DataFrame, form: Separated) -> scale.Stored:
    """The ranges that begin inside quotes; quotes that a file never closes are an error."""
    counted = scale.reread(pieces.groupBy(*_RANGE).agg(F.sum(form.odd(F.col("value")).cast("long")).alias("odd")))
    for row in counted.groupBy("file").agg((F.sum("odd") % 2).alias("open")).where("open = 1").limit(1).collect():
        raise ValueError(f"MALFORMED record: quotes are not closed in {row['file']}")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    started = counted.withColumn("before", F.coalesce(F.sum("odd").over(before), F.lit(0)))
    return scale.store(started.where("before % 2 = 1").select(*_RANGE, F.lit(True).alias("inside")))


def _put_together(form: Separated) -> Callable:
    separator = form.separator.encode()
    valid = re.compile(form.valid.encode()) if form.valid else None

    def joined(parts: list[bytes]) -> bytes:
        return parts[0] if len(parts) == 1 else separator.join(parts)

    def checked(record: bytes) -> bytes:
        if valid and not valid.fullmatch(record):
            raise ValueError(f"MALFORMED record: quotes inside an unquoted field: {record[:200]!r}")
        return record

    def run(batches):
        at, nth, inside, open_ = None, 0, False, []

        def rows(kind, records):
            nonlocal nth
            n = len(records)
            columns = [
                pa.array([at[0]] * n),
                pa.array([at[1]] * n, pa.int64()),
                pa.array(np.arange(nth, nth + n)),
                pa.array([kind] * n, pa.int32()),
                records if isinstance(records, pa.Array) else pa.array(records, pa.binary()),
            ]
            nth += n
            return pa.RecordBatch.from_arrays(columns, names=["file", "start", "nth", "kind", "record"])

        for batch in batches:
            changes = np.flatnonzero(
                pc.or_(
                    pc.not_equal(batch["file"].slice(1), batch["file"].slice(0, batch.num_rows - 1)),
                    pc.not_equal(batch["start"].slice(1), batch["start"].slice(0, batch.num_rows - 1)),
                ).to_numpy(zero_copy_only=False)
            )
            for a, b in zip([0, *(changes + 1)], [*(changes + 1), batch.num_rows]):
                part = batch.slice(a, b - a)
                if not part.num_rows:
                    continue
                here = (part["file"][0].as_py(), part["start"][0].as_py())
                if here != at:
                    if open_:
                        # what goes on in the next range; a range without any end is one long head
                        yield rows(MIDDLE if begun_inside else TAIL, [joined(open_)])
                    at, nth, open_ = here, 0, []
                    inside = begun_inside = bool(part["inside"][0].as_py())
                value = part["value"]
                odd = part["odd"].to_numpy(zero_copy_only=False)
                ends = (inside + np.cumsum(odd)) % 2 == 0
                if not open_ and ends.all():
                    yield rows(WHOLE, value)
                    continue
                pieces, since = value.to_pylist(), 0
                inside = not ends[-1]
                whole = []
                for end in np.flatnonzero(ends):
                    parts = [*open_, *pieces[since : end + 1]]
                    record, open_, since = joined(parts), [], end + 1
                    if begun_inside:
                        yield rows(HEAD, [record])
                        begun_inside = False
                    else:
                        whole.append(checked(record) if len(parts) > 1 else record)
                open_ += pieces[since:]
                if whole:
                    yield rows(WHOLE, whole)
        if open_:
            yield rows(MIDDLE if begun_inside else TAIL, [joined(open_)])

    return run


def records(spark: SparkSession, files: Sequence[str], form: Separated) -> DataFrame | None:
    """``(file, start, nth, record)``: records with the range they begin in and their order there.

    A record whose quotes are never closed is an error.  None comes back where the
    ranges that begin inside quotes are too many to be known to all tasks.
    """
    pieces = _pieces(spark, files, form)
    inside = _inside_quotes(pieces, form)
    if not inside.fits_broadcast:
        return None
    schema = "file string, start long, nth long, kind int, record binary"
    run = _put_together(form)

    def put_together(rows: DataFrame) -> DataFrame:
        # a broadcast join keeps the order of a range
        marked = rows.join(F.broadcast(inside.df), list(_RANGE), "left").select(
            *_RANGE,
            F.coalesce("inside", F.lit(False)).alias("inside"),
            form.odd(F.col("value")).alias("odd"),
            F.col("value").cast("binary").alias("value"),
        )
        return marked.mapInArrow(run, schema)

    whole = put_together(pieces).where(F.col("kind") == WHOLE).drop("kind")
    if not inside.rows:
        return whole
    # the files in which a record goes over the end of a range are read once more for its parts
    with_parts = F.broadcast(inside.df.select("file").distinct())
    parts = put_together(pieces.join(with_parts, "file", "left_semi")).where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", "nth")
    numbered = parts.withColumn("of", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    piece = F.struct("start", "nth", F.hex("record").alias("text"))
    chained = numbered.groupBy("file", "of").agg(F.array_sort(F.collect_list(piece)).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), form.separator.encode().hex())
    first = F.col("parts")[0]
    return whole.unionAll(chained.select("file", first["start"], first["nth"], F.unhex(text)))


_CLOSED_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# the opening of a document, of a column, a member, the closing of a column, of the document
_MEMBER = (
    rf'(?s)^\s*(\{{)?\s*(?:({_CLOSED_TEXT})\s*:\s*(\{{))?\s*'
    rf'(?:({_CLOSED_TEXT})\s*:\s*({_CLOSED_TEXT}|[^\s"{{}}\[\],:]+))?\s*(\}})?\s*(\}})?\s*$'
)


def columnar_json(spark: SparkSession, files: Sequence[str], columns: Sequence[str]) -> DataFrame | None:
    """Rows of column-oriented documents, one per file: the n-th values of ``columns`` belong together.

    Every range of a document gives its members; how many there are in the ranges
    before makes their positions, and values of one position meet in a shuffle.  None
    comes back where ``records`` gives none.
    """
    found = records(spark, files, JSON_MEMBERS)
    if found is None:
        return None
    text = F.col("record").cast("string")

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(text, _MEMBER, group), F.lit(""))

    bad = F.raise_error(F.concat(F.lit("Malformed member, or a nested value: "), F.substring(text, 1, 200)))
    member = F.when(F.regexp_like(text, F.lit(_MEMBER)), part(4)).otherwise(bad.cast("string"))
    value = F.from_json(F.concat(F.lit("["), part(5), F.lit("]")), "array<string>", {"mode": "FAILFAST"})[0]
    members = scale.reread(
        found.select(
            *_RANGE,
            "nth",
            part(1).isNotNull().cast("int").alias("opens"),
            F.from_json(F.concat(F.lit("["), part(2), F.lit("]")), "array<string>")[0].alias("column"),
            member.isNotNull().cast("long").alias("member"),
            value.alias("value"),
            (part(6).isNotNull().cast("int") + part(7).isNotNull().cast("int")).alias("closes"),
        )
    )
    inside = Window.partitionBy(*_RANGE).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = members.groupBy(*_RANGE).agg(F.sum("member").alias("n"))
    ranges = scale.store(counted.select(*_RANGE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    placed = scale.lookup(members.withColumn("_nth", F.sum("member").over(inside)), [ranges], list(_RANGE))
    placed = scale.reread(placed.withColumn("place", F.col("_before") + F.col("_nth")))
    # where columns begin and end: as many rows as documents
    begins = placed.where("column is not null").select("file", "column", (F.col("place") - F.col("member")).alias("after"))
    total = placed.groupBy("file").agg(
        F.sum("member").alias("total"), F.sum("opens").alias("opens"), F.sum("closes").alias("closes")
    )
    named = F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "after")))).alias("begins")
    documents = begins.groupBy("file").agg(named, F.count(F.lit(1)).alias("columns")).join(total, "file", "right")
    ends = F.array_sort(F.concat(F.map_values("begins"), F.array("total")))
    complete = (F.col("opens") == 1) & (F.col("closes") == F.col("columns") + 1)

    def bounds(column: str) -> Column:
        begin = F.try_element_at("begins", F.lit(column))
        # columns without members begin where the next one does
        end = F.array_min(F.filter(ends, lambda e: e > begin))
        return F.struct(F.coalesce(begin, F.lit(0)).alias("after"), F.coalesce(end, begin, F.lit(0)).alias("until"))

    spans = [bounds(c).alias(f"_{i}") for i, c in enumerate(columns)]
    documents = documents.select("file", F.assert_true(F.coalesce(complete, F.lit(False)), F.lit("Malformed document")).alias("_ok"), *spans)
    spans = scale.store(documents.drop("_ok").where(documents["_ok"].isNull()))
    return _by_position(placed.where("member = 1").select("file", "place", "value"), spans, columns)


def _by_position(values: DataFrame, spans: scale.Stored, columns: Sequence[str]) -> DataFrame:
    known = scale.lookup(values, [spans], ["file"])
    lengths = [F.col(f"_{i}")["until"] - F.col(f"_{i}")["after"] for i in range(len(columns))]
    uneven = F.least(*lengths) != F.greatest(*lengths) if len(lengths) > 1 else F.lit(False)
    position = F.when(uneven, F.raise_error(F.lit("columns of a document differ in length")).cast("long"))
    which = F.lit(None).cast("int")
    for i in range(len(columns)):
        span = F.col(f"_{i}")
        within = (F.col("place") > span["after"]) & (F.col("place") <= span["until"])
        position = position.when(within, F.col("place") - span["after"])
        which = F.when(within, i).otherwise(which)
    placed = known.select("file", position.alias("position"), which.alias("which"), "value").where("position is not null")
    picked = [F.max(F.when(F.col("which") == i, F.col("value"))).alias(c) for i, c in enumerate(columns)]
    return placed.groupBy("file", "position").agg(*picked).select(*[f"`{c}`" for c in columns])

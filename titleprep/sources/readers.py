"""CSV and JSON scans.  Fields stay text; cleaning types them once."""

from __future__ import annotations

import csv
import functools
import io
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from titleprep.sources import ranges

Paths = str | Sequence[str]

# what readers may call an unnamed first column
INDEX_COLUMNS = ("column0", "_c0", "Unnamed: 0")
_HEADERS_AT_ONCE = 16
_HEADER_BYTES = 4_096
# a record up to a line break outside quotes
_RECORD = re.compile(rb'((?:[^"\r\n]|"(?:[^"]|"")*+")*+)[\r\n]')


def text_schema(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def _listed(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


@dataclass(frozen=True)
class _Header:
    """What the first record of a file says: column names, blank lines before it, whether the file is large."""

    columns: tuple[str, ...]
    blank: int
    large: bool


def _is_large(spark: SparkSession, file: str) -> bool:
    """Whether a file is more than Spark gives to one task, and can be cut."""
    path, codec = _opened(spark, file)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return codec is None and size > spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def _opened(spark: SparkSession, file: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    return path, jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)


def _header(spark: SparkSession, file: str) -> _Header | None:
    """The header of one file, from its first bytes; no Spark job."""
    path, codec = _opened(spark, file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        stream = codec.createInputStream(stream) if codec is not None else stream
        data, blank, more = b"", 0, True
        while more:
            chunk = bytes(stream.readNBytes(_HEADER_BYTES))
            more, data = len(chunk) > 0, data + chunk
            text = data.removeprefix(b"\xef\xbb\xbf")
            blank = len(re.match(rb"(?:\r?\n)*", text)[0].replace(b"\r", b""))
            found = _RECORD.match(text.lstrip(b"\r\n"))
            if found or not more:
                record = found[1] if found else text.lstrip(b"\r\n")
                break
    finally:
        stream.close()
    if not record:
        return None
    names = next(csv.reader(io.StringIO(record.decode("utf-8", "replace"), newline="")))
    return _Header(_safe_names(names), blank, _is_large(spark, file))


def _safe_names(names: Sequence[str]) -> tuple[str, ...]:
    """Names as Spark's reader gives them: numbered where empty or repeated."""
    lower = [n.lower() for n in names]
    return tuple(
        f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)
    )


def _by_header(spark: SparkSession, paths: Paths) -> dict[_Header, list[str]]:
    """The files of ``paths`` by what their first records say; only these are read, by the driver."""
    files = sorted(spark.read.text(_listed(paths)).inputFiles())
    with ThreadPoolExecutor(_HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: _header(spark, file), files))
    groups: dict[_Header, list[str]] = {}
    for file, header in zip(files, headers):
        if header:
            groups.setdefault(header, []).append(file)
    return groups


def _escaped(file: str) -> str:
    """The name of one file as a path pattern that matches it alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def read_csv(
    spark: SparkSession,
    paths: Paths,
    schema: StructType | None = None,
    multiline: bool = True,
    keep_empty: bool = False,
    by_ranges: bool | None = None,
) -> DataFrame:
    """One file, a folder, a glob or a list of these, as one table of text columns.

    Columns are matched by the header line of each file, so files may have them in
    another order or lack some (null).  With ``schema`` its columns come back and no
    others.  A row with more or fewer fields than its header is an error, also for a
    query that needs only some columns.  Quotes are doubled inside quoted fields.  With
    ``multiline`` fields may hold line breaks; files larger than what Spark gives to a
    task are then read by several tasks (``ranges``), or as told by ``by_ranges``.
    There, quotes must enclose whole fields, others are an error, and line breaks in
    fields stay as they are (one task makes them all alike).  An empty field is
    null, quoted or not; with ``keep_empty`` a quoted one is the empty text.
    """
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    if keep_empty:
        # any text that is not empty tells a missing field from a quoted empty one
        options |= {"nullValue": "\u0001", "emptyValue": ""}
    tables = []
    for header, files in _by_header(spark, paths).items():
        fields, files = text_schema(*header.columns), [_escaped(f) for f in files]
        table = None
        if multiline and (header.large if by_ranges is None else by_ranges):
            table = _csv_by_ranges(spark, files, fields, header.blank, options)
        if table is None:
            # without column pruning every row is checked in full
            reader = spark.read.options(header=True, multiLine=multiline, columnPruning=False, **options)
            table = reader.schema(fields).csv(files)
        tables.append(table)
    if not tables:
        return spark.createDataFrame([], schema or text_schema())
    table = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    if schema is None:
        return table
    known = {c.lower(): c for c in table.columns}
    return table.select(
        *[
            F.col(f"`{known[f.name.lower()]}`").cast(f.dataType).alias(f.name)
            if f.name.lower() in known
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _csv_by_ranges(
    spark: SparkSession, files: Sequence[str], fields: StructType, blank: int, options: dict[str, str]
) -> DataFrame | None:
    found = ranges.records(spark, files, ranges.CSV)
    if found is None:
        return None
    text = F.regexp_replace(F.col("record").cast("string"), "\r$", "")
    is_header = (F.col("start") == 0) & (F.col("nth") == blank)
    rows = found.where(~is_header).select(text.alias("record")).where("record <> ''")
    plain = ", ".join(f"_{i} string" for i in range(len(fields)))
    return rows.select(F.inline(F.array(F.from_csv("record", plain, options)))).toDF(*fields.names)


def read_records(
    spark: SparkSession, paths: Paths, schema: StructType | str, multiline: bool = False
) -> DataFrame:
    """Records in JSON: one per line, or with ``multiline`` an array per file.

    A record that cannot be read is an error.
    """
    return spark.read.schema(schema).json(_listed(paths), multiLine=multiline, mode="FAILFAST")


def read_columnar_json(
    spark: SparkSession, paths: Paths, *columns: str, multiline: bool = True, by_ranges: bool | None = None
) -> DataFrame:
    """Rows from ``{"a": {k: v, ...}, "b": {k: v, ...}}``: the n-th values belong together.

    Inner keys are ignored.  Documents, one per file (or one per line with
    ``multiline=False``), are read in parallel.  A file larger than what Spark gives to
    a task is read by several tasks (``ranges``), or as told by ``by_ranges``; its
    values must be single ones.
    """
    if multiline:
        files = sorted(spark.read.text(_listed(paths)).inputFiles())
        large = [f for f in files if (_is_large(spark, f) if by_ranges is None else by_ranges)]
        if large:
            table = ranges.columnar_json(spark, [_escaped(f) for f in large], columns)
            if table is not None:
                rest = [_escaped(f) for f in files if f not in set(large)]
                return table.unionAll(read_columnar_json(spark, rest, *columns)) if rest else table
    schema = ", ".join(f"`{c}` map<string,string>" for c in columns)
    documents = read_records(spark, paths, schema, multiline)
    values = [F.map_values(c).alias(c) for c in columns]
    lists = documents.select(*values)
    sizes = [F.coalesce(F.size(c), F.lit(0)) for c in columns]
    aligned = F.when(F.least(*sizes) == F.greatest(*sizes), F.arrays_zip(*columns)).otherwise(
        F.raise_error(F.lit("columns of a document differ in length"))
    )
    return lists.select(F.inline(aligned))

"""What keeps joins and re-used results safe on a cluster.

``store``   writes a result to the shared folder and reads it back, so that it
            is computed once and survives the loss of an executor.
``lookup``  left join against tables that are unique by key: broadcast when the
            measured size allows it, otherwise a shuffle in which hot keys and
            null keys are spread over many tasks.  ``sparse`` lookups keep rows
            without a match out of that shuffle by a filter of the table's keys.
"""

from __future__ import annotations

import contextlib
import functools
import json
import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructField, StructType

BROADCAST_BYTES = 32 << 20
# a key is hot when it holds more rows than a task has on average, and too many for a single
# task to take without notice; the sketch finds keys above one row in HOT_SHARE
HOT_SHARE = 20_000
HOT_ROWS = 100_000
_TRACKED_KEYS = 60_000
_SKETCH_GROUPS = 256
_FILTER_BITS = 16  # for each key: one absent key in 16 passes the filter
_BITMAP = 32_768  # bits of one bitmap


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share.

    The one named in ``spark.checkpoint.dir``, else the context's checkpoint
    folder, else the session's warehouse.  A warehouse on local disks is refused on
    a cluster, where every executor would write to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            refuse_local(path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme())
    return folder.rstrip("/")


def refuse_local(scheme: str) -> None:
    if scheme == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share; the warehouse is on local disks")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/titleprep/{spark.conf.get('spark.app.id')}"


# the tables of jobs that run now, innermost last
_STAGED: list[list[str]] = []


def new_path(spark: SparkSession) -> str:
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    if _STAGED:
        _STAGED[-1].append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Staging:
    """The tables stored in a ``staging`` block."""

    def __init__(self, spark: SparkSession, paths: list[str]):
        self._spark, self._paths = spark, paths

    def keep(self, *results: DataFrame | Stored | None) -> None:
        """Tables that these results read outlive the block; an enclosing block takes them over."""
        used = set()
        for result in results:
            df = result.df if isinstance(result, Stored) else result
            used |= {file.rsplit("/", 1)[0].rsplit("/", 1)[-1] for file in df.inputFiles()} if df is not None else set()
        kept = [p for p in self._paths if p.rsplit("/", 1)[-1] in used]
        for path in kept:
            self._paths.remove(path)
            for outer in _STAGED[-2:-1]:
                outer.append(path)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """Delete what is stored inside at the end of the block, also when it fails, but for what is kept.

    Frames made inside are of no use after it unless they are kept or written
    elsewhere.  One thread opens blocks; tables that other threads store meanwhile
    belong to the innermost one.
    """
    paths: list[str] = []
    _STAGED.append(paths)
    try:
        yield Staging(spark, paths)
    finally:
        _STAGED.remove(paths)
        for path in paths:
            _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Delete everything that this application has stored; frames that read it are of no use after."""
    _delete(spark, _own_folder(spark))


@dataclass(frozen=True)
class Stored:
    """A written table, its size, and aggregates taken while measuring it."""

    df: DataFrame
    rows: int
    bytes: float
    values: dict = field(default_factory=dict)

    @property
    def fits_broadcast(self) -> bool:
        return self.bytes <= BROADCAST_BYTES


def reread(df: DataFrame, types: Mapping[str, DataType] | None = None) -> DataFrame:
    """``df`` written once to the shared folder; columns in ``types`` are read as what their fields make up."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    schema = StructType([StructField(f.name, (types or {}).get(f.name, f.dataType)) for f in df.schema.fields])
    return df.sparkSession.read.schema(schema if types else df.schema).parquet(path)


def _size(field: StructField) -> Column:
    """Bytes of a value beyond a fixed width."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (StringType, BinaryType)):
        return F.octet_length(column)
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        return F.octet_length(F.to_json(F.struct(column)))
    return F.lit(0)


def store(df: DataFrame, **values: Column) -> Stored:
    """Write ``df``, then measure it (and ``values``) in one pass over the written table."""
    table = reread(df)
    sized = [F.coalesce(_size(f), F.lit(0)) for f in table.schema.fields]
    per_row = functools.reduce(lambda a, b: a + b, sized, F.lit(16 * len(table.columns)))
    row = table.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.coalesce(F.sum(per_row), F.lit(0)).alias("_bytes"),
        *[column.alias(name) for name, column in values.items()],
    ).first()
    return Stored(table, row["_rows"], row["_bytes"], {name: row[name] for name in values})


def spread_scan(df: DataFrame) -> DataFrame:
    """A scan whose files give fewer partitions than there are cores, spread over all cores.

    For costly expressions on few large row groups; a scan of many files stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def unmeasured(df: DataFrame) -> Stored:
    """A table too large to be worth measuring: always joined by shuffle."""
    return Stored(df, -1, math.inf)


def literal_table(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """A few values as a table, held in the plan itself, without Python workers."""
    names = [field.split()[0] for field in schema.split(",")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    fields = ",".join(f"{f.split()[0]}:{f.split()[1]}" for f in schema.split(","))
    values = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    return spark.range(1, numPartitions=1).select(F.inline(values))


def _key_hash(keys: Sequence[str]) -> Column:
    known = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(known, F.xxhash64(*keys))


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> list[tuple[int | None, float]]:
    """Hashes of the hot keys, with their share of the rows; null stands for unknown keys.

    A frequent-items sketch finds them in one pass without a shuffle of the
    rows.  No more than the number of shuffle partitions come back.  The result only steers how
    rows are spread; it never changes what a join returns.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(tasks, HOT_SHARE)
    sketch = f"approx_top_k_accumulate(_key, {_TRACKED_KEYS})"
    merged = f"approx_top_k_estimate(approx_top_k_combine(_sketch, {_TRACKED_KEYS}), {share})"
    found = (
        rows.select(_key_hash(keys).alias("_key"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("_group"))
        .agg(F.expr(sketch).alias("_sketch"), F.count(F.lit(1)).alias("_n"))
        # grouped, so that no rows give no result
        .groupBy(F.lit("all"))
        .agg(F.expr(merged).alias("top"), F.sum("_n").alias("n"))
        .select("n", F.inline("top"))
        .where((F.col("count") * share > F.col("n")) & (F.col("count") >= HOT_ROWS))
        .collect()
    )
    return [(r["item"], r["count"] / r["n"]) for r in found]


@dataclass(frozen=True)
class KeyFilter:
    """Bits at the hashes of a table's keys, as bitmaps of 4 KB; ``size`` bits in all.

    A row that fails has no match; one that passes need not have one.
    """

    bitmaps: DataFrame
    size: int

    @classmethod
    def of(cls, table: Stored, keys: Sequence[str]) -> KeyFilter | None:
        """A filter sized from the rows that were counted; None where it is unknown or beyond a broadcast.

        Places are shuffled before they become bits, so what moves grows with the
        keys and not with the number of tasks.
        """
        bitmaps = -(-max(table.rows, 1) * _FILTER_BITS // _BITMAP)
        if table.rows < 0 or bitmaps * _BITMAP // 8 > BROADCAST_BYTES:
            return None
        places = cls._placed(table.df, keys, bitmaps * _BITMAP).select("_bitmap", "_bit").dropna()
        found = places.repartition("_bitmap").groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        return cls(reread(found), bitmaps * _BITMAP)

    @staticmethod
    def _placed(rows: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
        place = F.pmod(_key_hash(keys), F.lit(size))
        return rows.withColumns(
            {"_bitmap": F.floor(place / _BITMAP).cast("long"), "_bit": F.pmod(place, F.lit(_BITMAP)).cast("long")}
        )

    def passes(self, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        """``rows`` with a boolean column ``name``; false for unknown keys."""
        octet = F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))
        octet = F.conv(F.hex(octet), 16, 10).cast("int")
        is_set = F.coalesce(F.getbit(octet, F.col("_bit") % 8) == 1, F.lit(False))
        return (
            self._placed(rows, keys, self.size)
            .join(F.broadcast(self.bitmaps), "_bitmap", "left")
            .withColumn(name, is_set)
            .drop("_bitmap", "_bit", "_bits")
        )


def lookup(
    rows: DataFrame,
    tables: Sequence[Stored],
    keys: Sequence[str],
    copies: bool = False,
    even: bool = False,
    sparse: bool = False,
) -> DataFrame:
    """Left join ``rows`` with ``tables``, each unique by ``keys``; columns keep their order.

    ``copies`` says that ``rows`` may hold many fully identical rows, which a
    hash of the row could not spread; ``even`` that no key occurs in many rows,
    which spares the search for hot keys.  ``sparse`` says that many rows have no
    match: where tables are joined by shuffle and their keys fit a filter that can be
    broadcast, those rows stay out of it.  ``rows`` are then read twice, so they should
    be a table or little more than one.
    """
    keys = list(keys)
    columns = rows.columns + [c for t in tables for c in t.df.columns if c not in keys]
    small = [t for t in tables if t.fits_broadcast]
    large = [t for t in tables if not t.fits_broadcast]
    for table in small:
        rows = rows.join(F.broadcast(table.df), keys, "left")
    filters = [KeyFilter.of(t, keys) for t in large] if sparse else []
    if filters and all(filters):
        names = [f"_passes_{i}" for i in range(len(filters))]
        for key_filter, name in zip(filters, names):
            rows = key_filter.passes(rows, keys, name)
        some = functools.reduce(lambda a, b: a | b, map(F.col, names))
        absent = {f.name: F.lit(None).cast(f.dataType) for t in large for f in t.df.schema.fields if f.name not in keys}
        apart = rows.where(~some).drop(*names).withColumns(absent)
        joined = _shuffle_join(rows.where(some).drop(*names), large, keys, copies, even)
        rows = joined.unionByName(apart.select(*joined.columns))
    elif large:
        rows = _shuffle_join(rows, large, keys, copies, even)
    return rows.select(*[f"`{c}`" for c in columns])


def _shuffle_join(rows, tables, keys, copies, even):
    hot = [] if even else hot_keys(rows, keys)
    if hot:
        return _spread_join(rows, tables, keys, hot, copies).drop("_salt")
    for table in tables:
        # too large, or of unknown size: no estimate shall turn this into a broadcast
        rows = rows.join(table.df.hint("merge"), keys, "left")
    return rows


def _spread_join(rows, tables, keys, hot, copies):
    """Rows of a hot key get one of several salts; its table row is repeated for each salt.

    The number of salts follows the share of the key: four for each task's worth of
    rows, which evens out where they land.  All repeated rows together are at most
    four per shuffle partition plus one per hot key.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = [(key, math.ceil(4 * share * tasks) + 1) for key, share in hot if key is not None]
    hot_table = literal_table(spark, "_key bigint, _salts int", salts)
    if copies:
        # positions in a written table stay the same when a task is run again
        rows = reread(rows)
        place = F.monotonically_increasing_id()
    else:
        hashable = [f"`{f.name}`" for f in rows.schema.fields if not isinstance(f.dataType, MapType)]
        place = F.xxhash64(*hashable)
    spread = F.when(F.col("_key").isNull(), F.lit(4 * tasks)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = (
        rows.withColumns({"_key": _key_hash(keys), "_place": place})
        .join(F.broadcast(hot_table), "_key", "left")
        .withColumn("_salt", F.pmod("_place", spread).cast("int"))
        .drop("_key", "_salts", "_place")
    )
    for table in tables:
        repeated = (
            table.df.withColumn("_key", _key_hash(keys))
            .join(F.broadcast(hot_table), "_key", "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
            .drop("_key", "_salts")
        )
        salted = salted.join(repeated.hint("merge"), [*keys, "_salt"], "left")
    return salted

"""Reports over tables that grow by shards: states per shard, stored and combined.

A shard is profiled once, when it arrives.  Its state holds counts and extremes, a
distinct-value sketch per column, and the digests of the distinct values themselves.
Reports over any number of shards combine states and never read rows again; writing a
shard again replaces its state.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleprep.operators import profile

_SKETCH_BITS = 14


def check_state(df: DataFrame) -> DataFrame:
    """``(section, item, value)`` as in ``profile.report``; extremes of no values are null."""
    return profile.report(df)


def combine_checks(states: DataFrame) -> DataFrame:
    """``profile.report`` of all rows together: counts add up, extremes are taken again."""
    item = F.col("item")
    value = (
        F.when(item.startswith("min_"), F.min("value"))
        .when(item.startswith("max_"), F.max("value"))
        # counts are whole numbers, which a sum of doubles keeps up to 2 ** 53
        .otherwise(F.sum("value"))
    )
    return states.groupBy("section", "item").agg(value.alias("value"))


def column_state(df: DataFrame) -> DataFrame:
    """``(column, rows, count, sketch)``: one pass without a shuffle of the rows."""
    found = [
        F.struct(
            F.lit(n).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count(F.col(f"`{n}`")).alias("count"),
            F.hll_sketch_agg(F.when(F.col(f"`{n}`").isNotNull(), profile.digest(n, kind)["a"]), _SKETCH_BITS).alias("sketch"),
        )
        for n, kind in df.dtypes
    ]
    return df.agg(F.array(*found).alias("found")).select(F.inline("found"))


def value_state(df: DataFrame) -> DataFrame:
    """``(column, a, b)``: the digest of every distinct value of a column, null left out."""
    cells = [
        F.when(F.col(f"`{n}`").isNotNull(), F.struct(F.lit(n).alias("column"), profile.digest(n, kind).alias("value")))
        for n, kind in df.dtypes
    ]
    rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    return rows.select("cell.column", "cell.value.a", "cell.value.b").distinct()


def combine_columns(states: DataFrame, values: DataFrame | None = None, order_by: str = "null_pct") -> DataFrame:
    """``profile.column_summary`` of all rows together; distinct values are estimated without ``values``."""
    unique = F.lit(0) if values is not None else F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    counted = states.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("count").alias("count"), unique.alias("unique")
    )
    if values is not None:
        distinct = values.select("column", "a", "b").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("exact"))
        counted = counted.join(distinct, "column", "left").withColumn("unique", F.coalesce("exact", F.lit(0)))
    nulls = F.col("rows") - F.col("count")
    return counted.select(
        "column",
        "count",
        nulls.alias("nulls"),
        F.try_divide(nulls * 100.0, F.col("rows")).alias("null_pct"),
        F.col("unique").cast("long").alias("unique"),
    ).orderBy(F.desc(order_by), "column")


@dataclass(frozen=True)
class ProfileStates:
    """The states of the shards of one table, below ``folder``."""

    folder: str

    def _path(self, kind: str, shard: str = "") -> str:
        return f"{self.folder}/{kind}" + (f"/shard={quote(shard, safe='')}" if shard else "")

    def add(self, shard: str, df: DataFrame) -> None:
        """Store the state of a shard, in place of the one it had."""
        for kind, state in (("checks", check_state), ("columns", column_state), ("values", value_state)):
            state(df).write.mode("overwrite").parquet(self._path(kind, shard))

    def report(self, spark: SparkSession) -> DataFrame:
        return combine_checks(spark.read.parquet(self._path("checks")))

    def summary(self, spark: SparkSession, approximate: bool = False, order_by: str = "null_pct") -> DataFrame:
        values = None if approximate else spark.read.parquet(self._path("values"))
        return combine_columns(spark.read.parquet(self._path("columns")), values, order_by)

"""People per title as comma lists, joined to the titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleprep import scale


def group_list(pairs: DataFrame, key: str, element: str, alias: str) -> DataFrame:
    """All elements per key in one comma list, in order; nulls left out, repeats kept.

    Repeats are counted before the lists are built, so copies of a pair cross
    the network once per task and not once each.  If some key is hot, all pairs are
    sorted over all tasks first: a task then joins the run of a key that it has, and
    the last step only puts finished runs one after the other.
    """
    counted = pairs.groupBy(key, element).agg(F.count(F.lit(1)).alias("_n"))
    once = F.when(F.col("_n") == 1, F.col(element)).otherwise(
        F.concat(F.repeat(F.concat(F.col(element), F.lit(",")), F.col("_n").cast("int") - 1), F.col(element))
    )
    entries = counted.select(key, F.col(element).alias("_element"), once.alias("_text"))
    if scale.hot_keys(pairs.select(key).where(F.col(key).isNotNull()), [key]):
        entries = _runs(entries, key)
    lists = entries.groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(F.col("_element").isNotNull(), F.struct("_element", "_text")))).alias("_l")
    )
    joined = F.array_join(F.transform("_l", lambda e: e["_text"]), ",")
    return lists.select(key, F.when(F.size("_l") > 0, joined).alias(alias))


def _runs(entries: DataFrame, key: str) -> DataFrame:
    """Entries joined to one per key and task of a sort by key and element."""
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = entries.repartitionByRange(tasks, key, "_element").withColumn("_run", F.spark_partition_id())
    run = F.sort_array(F.collect_list(F.when(F.col("_element").isNotNull(), F.struct("_element", "_text"))))
    joined = spread.groupBy(key, "_run").agg(run.alias("_l"))
    # the least element of a run puts the runs of a key in order
    return joined.select(
        key,
        F.when(F.size("_l") > 0, F.col("_l")[0]["_element"]).alias("_element"),
        F.array_join(F.transform("_l", lambda e: e["_text"]), ",").alias("_text"),
    )


def add_lists(
    titles: DataFrame, *lists: DataFrame | scale.Stored, key: str = "tconst", even: bool = False
) -> DataFrame:
    """Left join of tables with one list per key; lists that are not stored are shuffled.

    ``even`` says that no key has many titles, which spares the search for hot keys.
    The titles are shuffled once for all lists, or not at all if the stored
    lists are small.
    """
    tables = [x if isinstance(x, scale.Stored) else scale.unmeasured(x) for x in lists]
    return scale.lookup(titles, tables, [key], copies=True, even=even)

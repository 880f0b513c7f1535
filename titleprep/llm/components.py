"""Connected components of a large graph, as joins and grouped minima.

Alternating "star" steps: every node hands its least neighbour to its larger
neighbours, then to its smaller ones.  Each step is a minimum per node (partial
before the shuffle) and a join; the edges end as stars around the least node of
each component, after a number of rounds that grows with the logarithm of the
longest path.  Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleprep.scale import reread


def _hand_over(edges: DataFrame) -> DataFrame:
    """For edges u -> v: the least of u and its neighbours, to all of them but itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _hand_over(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()
    small = _hand_over(large)
    to_smaller = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_smaller.union(small.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for all nodes of ``edges (u, v)`` but the least node of each component.

    ``edges`` are two columns of one integer type without nulls, in any direction,
    loops and repeats allowed.  No edges give no rows.
    """
    edges = reread(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    mark = (F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))))
    before = edges.agg(*mark).first()
    while before[0]:
        edges = reread(_round(edges))
        after = edges.agg(*mark).first()
        if tuple(after) == tuple(before):
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

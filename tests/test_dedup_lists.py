from pyspark.sql import functions as F

from conftest import rows_of
from titleprep import scale
from titleprep.operators import dedup, lists


def test_keep_first_is_the_smallest_row_with_nulls_first(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "x"), ("b", None, "q"), ("b", 0, "p"), (None, 1, "n"), (None, 2, "n")],
        "k string, n int, s string",
    )
    assert rows_of(dedup.keep_first(df, ["k"])) == sorted(
        [("a", 1, "x"), ("b", None, "q"), (None, 1, "n")], key=repr
    )
    by_text = dedup.keep_first(df, ["k"], order=[("o", F.col("s"))])
    assert ("b", 0, "p") in rows_of(by_text)


def test_keep_first_does_not_depend_on_the_order_of_rows(spark):
    df = spark.range(2_000).select((F.col("id") % 7).alias("k"), F.xxhash64("id").alias("v"), "id")
    assert rows_of(dedup.keep_first(df.repartition(5), ["k"])) == rows_of(dedup.keep_first(df.repartition(3, "v"), ["k"]))


def test_keep_first_reduces_copies_before_the_shuffle(spark):
    plan = dedup.keep_first(spark.range(10).withColumn("v", F.lit(1)), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_lists_keep_repeats_and_skip_nulls(spark):
    pairs = spark.createDataFrame(
        [("m1", "b"), ("m1", "a"), ("m1", "b"), ("m1", None), ("m2", None), ("m3", r"\N"), ("m4", "x"), ("m4", "x"), ("m4", "x")],
        "movie string, writer string",
    )
    assert rows_of(lists.group_list(pairs, "movie", "writer", "writers")) == [
        ("m1", "a,b,b"), ("m2", None), ("m3", r"\N"), ("m4", "x,x,x")
    ]


def test_add_lists(spark):
    titles = spark.createDataFrame([("t1", 1), ("t2", 2), ("t2", 2), (None, 3)], "tconst string, n int")
    a = spark.createDataFrame([("t1", "p,q"), ("t9", "z")], "tconst string, writers string")
    b = spark.createDataFrame([("t2", "d")], "tconst string, directors string")
    assert rows_of(lists.add_lists(titles, a, b)) == sorted(
        [("t1", 1, "p,q", None), ("t2", 2, None, "d"), ("t2", 2, None, "d"), (None, 3, None, None)], key=repr
    )


def test_list_of_a_hot_key_comes_from_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 100)
    i = F.col("id")
    pairs = spark.range(6_000).select(
        F.when(i % 3 == 0, "hot").when(i % 3 == 1, None).otherwise((i % 500).cast("string")).alias("movie"),
        F.when(i % 11 > 0, F.concat(F.lit("nm"), (i % 997).cast("string"))).alias("writer"),
    )
    seen, runs = [], lists._runs

    def watched(entries, key):
        found = runs(entries, key)
        seen.append(found.where(F.col(key) == "hot").count())
        return found

    monkeypatch.setattr(lists, "_runs", watched)
    hot = rows_of(lists.group_list(pairs, "movie", "writer", "writers"))
    assert len(seen) == 1 and seen[0] > 1
    monkeypatch.setattr(scale, "HOT_ROWS", 10**9)
    assert rows_of(lists.group_list(pairs, "movie", "writer", "writers")) == hot
    assert len(seen) == 1

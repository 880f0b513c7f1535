import dataclasses

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from titleprep import scale


@pytest.fixture(autouse=True)
def few_rows_are_hot(monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 100)


@pytest.fixture
def rows(spark):
    """A third of the rows share one key, a third have none, the rest differ."""
    i = F.col("id")
    return spark.range(9_000).select(
        "id",
        F.when(i % 3 == 0, "hot").when(i % 3 == 1, None).otherwise(F.concat(F.lit("k"), (i % 500).cast("string"))).alias("key"),
    )


@pytest.fixture
def table(spark):
    keys = [("hot", 1.0, None), *[(f"k{i}", float(i), str(i)) for i in range(0, 400)]]
    return scale.store(spark.createDataFrame(keys, "key string, x double, y string"), total=F.sum("x"))


def large(table):
    return dataclasses.replace(table, bytes=scale.BROADCAST_BYTES + 1)


def test_store_measures_what_it_wrote(table):
    assert table.rows == 401 and table.fits_broadcast
    assert table.values == {"total": 1.0 + sum(range(400))}
    assert table.bytes > 401 * 16


def test_store_of_nothing(spark):
    empty = scale.store(spark.createDataFrame([], "a string, b int"))
    assert (empty.rows, empty.bytes) == (0, 0) and empty.df.count() == 0


def test_hot_keys(rows):
    found = dict(scale.hot_keys(rows, ["key"]))
    hot = rows.sparkSession.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert found[hot] == pytest.approx(1 / 3, abs=0.01)
    assert found[None] == pytest.approx(1 / 3, abs=0.01)
    assert len(found) <= 8


def test_hot_keys_of_nothing_and_of_unique_keys(spark):
    assert scale.hot_keys(spark.createDataFrame([], "key string"), ["key"]) == []
    assert scale.hot_keys(spark.range(50_000), ["id"]) == []


@pytest.mark.parametrize("copies", [False, True])
def test_spread_join_equals_plain_join(rows, table, copies):
    plain = rows.join(table.df, "key", "left").select("id", "key", "x", "y")
    spread = scale.lookup(rows, [large(table)], ["key"], copies=copies)
    assert spread.columns == ["id", "key", "x", "y"]
    assert rows_of(spread) == rows_of(plain)
    assert rows_of(scale.lookup(rows, [table], ["key"])) == rows_of(plain)


def test_spread_join_keeps_identical_rows(spark, table):
    copies = spark.range(3_000).select(F.lit("hot").alias("key"), F.lit(1).alias("v"))
    joined = scale.lookup(copies, [large(table)], ["key"], copies=True)
    assert joined.groupBy("key", "v", "x", "y").count().collect() == [("hot", 1, 1.0, None, 3_000)]


def test_hot_rows_are_spread_over_tasks(rows, table):
    spread = scale.lookup(rows, [large(table)], ["key"])
    spread.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [
            r[0]
            for r in scale.lookup(rows, [large(table)], ["key"])
            .groupBy(F.spark_partition_id()).count().select("count").collect()
        ]
    finally:
        spread.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    # unspread, one task would hold the 3,000 hot rows and one the 3,000 null rows
    assert max(sizes) < 2 * 9_000 / 8


def test_keys_with_few_rows_are_not_hot(rows, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 3_001)
    assert scale.hot_keys(rows, ["key"]) == []


def test_two_tables_and_two_keys(spark, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 1)
    rows = spark.range(600).select("id", (F.col("id") % 2).alias("a"), F.when(F.col("id") % 5 > 0, F.lit("z")).alias("b"))
    one = scale.store(spark.createDataFrame([(0, "z", 10)], "a bigint, b string, p int"))
    two = scale.store(spark.createDataFrame([(1, "z", 20)], "a bigint, b string, q int"))
    plain = rows.join(one.df, ["a", "b"], "left").join(two.df, ["a", "b"], "left").select("id", "a", "b", "p", "q")
    for tables in ([one, two], [large(one), two], [large(one), large(two)]):
        assert rows_of(scale.lookup(rows, tables, ["a", "b"])) == rows_of(plain)


def test_unmeasured_tables_are_never_broadcast_by_hint(spark):
    assert not scale.unmeasured(spark.range(3)).fits_broadcast


def test_sizes_of_nested_and_binary_values_count(spark):
    df = spark.range(10).selectExpr("repeat('x', 5000) s", "cast(repeat('x', 5000) as binary) b",
                                    "array(repeat('x', 5000)) a", "map('k', repeat('x', 5000)) m")
    for column in df.columns:
        assert scale.store(df.select(column)).bytes >= 10 * 5_000


def test_folder_and_release(spark, tmp_path, monkeypatch):
    from pathlib import Path

    assert scale.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(scale, "shared_folder", lambda spark: str(tmp_path))
    assert scale.reread(spark.range(5)).count() == 5
    assert any(tmp_path.rglob("*.parquet"))
    scale.release(spark)
    assert not any(p.is_file() for p in Path(tmp_path).rglob("*"))


def test_folder_of_a_session_that_names_none():
    class Session:
        class conf:
            get = {"spark.sql.warehouse.dir": "file:/warehouse/"}.get

        class sparkContext:
            master = "local[2]"
            getCheckpointDir = staticmethod(lambda: None)

    assert scale.shared_folder(Session) == "file:/warehouse"
    Session.sparkContext.getCheckpointDir = staticmethod(lambda: "file:/checkpoints/1")
    assert scale.shared_folder(Session) == "file:/checkpoints/1"


def test_literal_table(spark):
    rows = [(1, 0.1, "a"), (-(2**62) - 1, 1e-300, None)]
    df = scale.literal_table(spark, "k bigint, x double, s string", rows)
    assert df.dtypes == [("k", "bigint"), ("x", "double"), ("s", "string")]
    assert rows_of(df) == sorted(rows, key=repr)
    assert scale.literal_table(spark, "k bigint", []).count() == 0


def test_staging_keeps_results_only(spark):
    with scale.staging(spark) as outer:
        lost = scale.reread(spark.range(3))
        with scale.staging(spark) as inner:
            gone, kept = scale.reread(spark.range(4)), scale.store(spark.range(5))
            joined = kept.df.join(scale.reread(spark.range(2)), "id")
            inner.keep(joined)
        assert joined.count() == 2 and lost.count() == 3
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FAILED_READ"):
            gone.collect()
        outer.keep(kept)
    assert kept.df.count() == 5
    for df in (lost, joined):
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FAILED_READ"):
            df.collect()


def test_staging_is_cleared_after_a_failure(spark):
    with pytest.raises(ValueError), scale.staging(spark):
        lost = scale.reread(spark.range(3))
        raise ValueError
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FAILED_READ"):
        lost.collect()
    assert scale._STAGED == []


def test_a_local_warehouse_is_refused_on_a_cluster():
    scale.refuse_local("hdfs")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scale.refuse_local("file")

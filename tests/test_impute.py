import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titleprep.operators import impute


def lower(values):
    return sorted(values)[math.ceil(len(values) / 2) - 1]


@pytest.mark.parametrize("limit", [impute.EXACT_DISTINCT, 50, 1])
@pytest.mark.parametrize("kind", ["disc", "cont"])
def test_exact_medians_with_and_without_narrowing(spark, kind, limit):
    df = spark.range(30_001).select(
        ((F.col("id") * 7919) % 30_011).cast("double").alias("spread"),
        F.pow(F.lit(1.001), F.col("id") % 5_000).alias("tail"),
        (F.col("id") % 2).cast("double").alias("two"),
        F.when(F.col("id") % 3 > 0, F.lit(5.0)).otherwise(F.col("id")).alias("hot"),
        F.lit(None).cast("double").alias("none"),
    )
    names = df.columns
    got = impute.exact_medians(df, {n: F.col(n) for n in names}, kind, limit)
    frame = df.toPandas()
    middle = lower if kind == "disc" else statistics.median
    for n in names[:-1]:
        assert got[n] == middle(list(frame[n])), n
    assert got["none"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=40).filter(lambda v: any(x is not None for x in v)))
def test_medians_of_any_list(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v is not None]
    assert impute.exact_medians(df, {"x": F.col("x")}, "disc", 1)["x"] == lower(known)
    assert impute.exact_medians(df, {"x": F.col("x")}, "cont", 1)["x"] == pytest.approx(statistics.median(known))


def test_imputer_uses_training_rows_only(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    other = spark.createDataFrame([(None,), (7.0,)], "x double")
    model = impute.MedianImputer(("x",)).fit(train)
    assert model.medians == {"x": 2.0}
    assert sorted(r[0] for r in model.transform(other).collect()) == [2.0, 7.0]
    assert impute.MedianImputer(("x",), "approx").fit(train).medians == {"x": 2.0}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert impute.exact_medians(df, {"x": F.col("x")}, "cont") == {"x": 2.0}


def test_fill_constant(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "genre string, other string")
    assert [tuple(r) for r in impute.fill_constant(df, "Unknown", "genre").collect()] == [("a", None), ("Unknown", "b")]


def test_sketches_that_do_not_narrow_are_halved(spark, monkeypatch):
    """Two heavy values at the ends: the exact step must never see more values than the limit."""
    values = [0.0] * 500 + [float(i) for i in range(1, 10)] + [10.0] * 500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    seen = []
    pick = impute._pick
    monkeypatch.setattr(impute, "_pick", lambda v, s: seen.extend(x.distinct for x in s.values()) or pick(v, s))
    for kind, expected in (("disc", 5.0), ("cont", 5.0)):
        assert impute.exact_medians(df, {"v": F.col("v")}, kind, limit=3) == {"v": expected}
    assert seen and max(seen) <= 3


@pytest.mark.parametrize("seed", range(2))
def test_halving_equals_sorting(spark, monkeypatch, seed):
    import random
    import statistics

    monkeypatch.setattr(impute, "_ACCURACY", 2)
    rng = random.Random(seed)
    values = [rng.choice([0.0, -1e300, 1e-300, 7.5, float("inf"), rng.gauss(0, 1e6)]) for _ in range(60 + seed)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert impute.exact_medians(df, {"v": F.col("v")}, "disc", limit=1)["v"] == statistics.median_low(values)
    assert impute.exact_medians(df, {"v": F.col("v")}, "cont", limit=1)["v"] == statistics.median(values)


def test_nan_is_filled(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    model = impute.MedianImputer(("v",), kind="cont").fit(df)
    assert sorted(r["v"] for r in model.transform(df).collect()) == [1.0, 2.0, 2.0, 3.0]

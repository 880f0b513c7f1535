import math

import pytest
from pyspark.sql import functions as F

from titleprep.functions import rules


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_only_the_exact_sentinel_becomes_null(spark):
    values = [r"\N", None, "", "N", "\\n", "1999", r"nm1,\N"]
    assert column(spark, values, "string", rules.drop_sentinel) == [None, None, *values[2:]]


def test_year_bounds_are_closed(spark):
    years = [1879, 1880, 2025, 2026, None]
    got = column(spark, years, "int", lambda c: rules.within(c, 1880, 2025))
    assert got == [None, 1880, 2025, None, None]


def test_runtime_leaves_zero_out(spark):
    got = column(spark, [-1.0, 0.0, 0.5, 600.0, 600.5, None], "double", lambda c: rules.above_up_to(c, 0, 600))
    assert got == [None, None, 0.5, 600.0, None, None]


def test_zero_votes_stay(spark):
    assert column(spark, [-1.0, 0.0, 3.0, None], "double", lambda c: rules.at_least(c, 0)) == [None, 0.0, 3.0, None]


def test_bad_numbers_become_null(spark):
    texts = ["1999", " 7 ", "1999.0", "-3.9", "x", "1999d", "", None]
    assert column(spark, texts, "string", rules.to_int) == [1999, 7, 1999, -3, None, None, None, None]
    assert column(spark, [1999.0, None], "double", rules.to_int) == [1999, None]
    assert column(spark, ["1.5", "abc", None], "string", rules.to_float) == [1.5, None, None]


def test_flag_from_boolean_and_text(spark):
    assert column(spark, [True, False, None], "boolean", rules.to_flag) == [1, 0, None]
    assert column(spark, ["True", "false", "maybe", None, "1"], "string", rules.to_flag) == [1, 0, None, None, 1]
    assert column(spark, [1, 0, None], "int", rules.to_flag) == [1, 0, None]
    assert column(spark, [1.0, 0.0, None], "double", rules.to_flag) == [1, 0, None]


def test_same_is_zero_for_null(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "A"), (None, "a"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(rules.same(F.col("a"), F.col("b"))).collect()] == [1, 0, 0, 0]


def test_year_of_first_date(spark):
    df = spark.createDataFrame(
        [("2001-05-01", "1999-01-01"), (None, "2004-02-03"), ("not a date", "1990-01-01"), ("bad", None)],
        "a string, b string",
    )
    got = [r[0] for r in df.select(rules.year_of_first(F.col("a"), F.col("b"))).collect()]
    assert got == [1999, 2004, 1990, None]


def test_log_count_is_32_bit(spark):
    import numpy as np

    got = column(spark, [0.0, 1000.0, 2_500_000.0, None], "double", rules.log_count)
    assert got[0] == 0.0 and got[3] is None
    assert got[1] == pytest.approx(float(np.float32(math.log1p(1000.0))), abs=1e-9)


def test_count_present(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(rules.count_present(F.col("a"), F.col("b"))).collect()] == [1, 0, 2]


def test_split_keeps_empty_elements_and_blanks(spark):
    assert column(spark, ["a, b,", "", None], "string", rules.split_list) == [["a", " b", ""], [""], None]

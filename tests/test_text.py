import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titleprep.functions import text


def expected(title):
    if title is None:
        return None
    letters = unicodedata.normalize("NFD", title).lower()
    return " ".join("".join(c for c in letters if c == "_" or c.isalnum() or c.isspace()).split())


def normalized(spark, titles, exact=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(text.normalize_title(F.col("t"), exact)).collect()]


TITLES = [
    None,
    "",
    "!!!",
    "Amélie",
    "  A  B ",
    "snake_case",
    "Straße",
    "İstanbul",
    "m²",
    "한국어 영화 값",
    "ΑΣ Σ ὈΔΥΣΣΕΎΣ.",
    "tab\tand\x1cseparator\x85next\xa0end",
    "ঢোকা ো",
    "Ⅷ ª º ½",
    "é combining",
    "Ǆ ﬁ Å",
    "日本語。タイトル",
]


@pytest.mark.parametrize("exact", [False, True])
def test_normalized_titles(spark, exact):
    assert normalized(spark, TITLES, exact) == [expected(t) for t in TITLES]


def test_every_letter_up_to_the_general_punctuation(spark):
    titles = [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x600)]
    assert normalized(spark, titles) == [expected(t) for t in titles]


def test_every_hangul_syllable(spark):
    titles = [chr(c) for c in range(0xAC00, 0xD7A4)]
    assert normalized(spark, titles) == [expected(t) for t in titles]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(max_codepoint=0x5FF, exclude_categories=["Cs"], exclude_characters="\x00")), min_size=1, max_size=50))
def test_idempotent_and_equal_to_python(spark, titles):
    once = normalized(spark, titles)
    assert once == [expected(t) for t in titles]
    assert normalized(spark, once) == once


def test_tags(spark):
    lists = ["  Drama , Mystery & thriller ", "A,,B", " ", " ,x", "", "Kids & family", None, "Sci-fi"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.normalize_tags(F.col("t"))).collect()]

    def tags(value):
        return ",".join(t.strip().lower().translate({32: "_", 38: "and"}) for t in value.split(","))

    assert got == [None if t is None else tags(t) for t in lists]


def test_non_ascii(spark):
    df = spark.createDataFrame([("abc",), ("é",), ("\x7f",), ("\x80",), (None,)], "t string")
    assert [r[0] for r in df.select(text.is_non_ascii(F.col("t"))).collect()] == [False, True, False, True, None]

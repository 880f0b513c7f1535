import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from titleprep import scale
from titleprep.operators import match


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(left, right):
    return {
        (a, m, b, n, edits(a, b))
        for a, m in left
        for b, n in right
        if None not in (a, m, b, n) and abs(m - n) <= 1 and abs(len(a) - len(b)) <= 1 and edits(a, b) <= 1
    }


def near(spark, left, right):
    a = spark.createDataFrame(left, "t string, y int")
    b = spark.createDataFrame(right, "t string, y int")
    return match.near_pairs(a, b, ("t", "y"), ("t", "y"))


EDIT_TEXTS = ["", "a", "b", "ab", "ba", "abc", "xabc", "axbc", "abcx", "bc", "ac", "xbc", "axc", "abx", "aabb", "aab", "é", "éa", "한", "xyz"]


def test_edits_at_every_place(spark):
    left = [(t, 2000) for t in EDIT_TEXTS]
    right = [(t, y) for t in EDIT_TEXTS for y in (1998, 1999, 2000, 2001, 2002)] + [(None, 2000), ("a", None)]
    found = near(spark, left + [(None, 2000), ("a", None)], right)
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == brute_force(left, right)
    assert len(rows) == len(set(rows)), "a pair came twice"


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10**6))
def test_equal_to_all_pairs_on_random_texts(spark, seed):
    rng = random.Random(seed)
    words = [("".join(rng.choice("abé한 ") for _ in range(rng.randrange(0, 6))), rng.randrange(1, 5)) for _ in range(120)]
    left, right = words[:60], words[60:]
    rows = [tuple(r) for r in near(spark, left, right).collect()]
    assert set(rows) == brute_force(set(left), set(right)) and len(rows) == len(set(rows))


def test_copies_do_not_multiply_the_search(spark):
    left = [("title", 2000)] * 500
    assert rows_of(near(spark, left, left)) == [("title", 2000, "title", 2000, 0)]


CATALOG = [
    # title, theaters, streaming, tomatoMeter, audienceScore, genre
    ("Amélie!", "2001-05-01", None, 90, None, "Comedy"),
    ("amelie", "2001-01-01", "2005-01-01", 80, 70, "Drama"),
    ("Heat", "1995-12-15", None, None, None, "Crime"),
    ("Heats", "1996-01-01", None, 60, 61, "Other"),
    ("Alien", "bad", None, 99, 98, "Sci-fi"),
    ("Alien", None, "1979-05-25", 99, None, "Sci-fi"),
    (None, "2000-01-01", None, 1, 1, "None"),
    ("!!!", "2000-01-01", None, 5, 6, "Empty"),
]
COLUMNS = "title string, releaseDateTheaters string, releaseDateStreaming string, tomatoMeter int, audienceScore int, genre string"


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(CATALOG, COLUMNS)


def test_prepare_catalog(catalog):
    assert rows_of(match.prepare_catalog(catalog)) == [
        ("", 2000, 5.0, 6.0, "Empty"),
        ("alien", 1979, 99.0, None, "Sci-fi"),
        ("amelie", 2001, 80.0, 70.0, "Drama"),
        ("heat", 1995, None, None, "Crime"),
        ("heats", 1996, 60.0, 61.0, "Other"),
    ]


TITLES = [
    ("t1", "amelie", 2001),
    ("t2", "heat", 1995),  # the key matches, but without scores
    ("t3", "alen", 1980),
    ("t4", "alien", 1999),
    ("t5", "x", 2000),  # one edit from the empty title
    ("t6", None, 2000),
    ("t7", "heat", None),
    ("t8", "alen", 1980),
]
WANTED = {
    "t1": (80.0, 70.0, "Drama", "exact", 1),
    # distance 0 beats the scored neighbour at distance 1
    "t2": (None, None, "Crime", "near", 0),
    "t3": (99.0, None, "Sci-fi", "near", 1),
    "t4": (None, None, None, "none", 0),
    "t5": (5.0, 6.0, "Empty", "near", 1),
    "t6": (None, None, None, "none", 0),
    "t7": (None, None, None, "none", 0),
    "t8": (99.0, None, "Sci-fi", "near", 1),
}


@pytest.mark.parametrize("broadcast", [True, False])
def test_enrich(spark, catalog, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    titles = spark.createDataFrame(TITLES, "tconst string, normalized_title string, year int")
    out = match.Enricher.fit(catalog).transform(titles)
    assert out.columns == [*titles.columns, "tomatoMeter", "audienceScore", "genre", "match_stage", "has_rt_match"]
    got = {r["tconst"]: tuple(r)[3:] for r in out.collect()}
    assert got == WANTED
    counts = {r["match_stage"]: r["rows"] for r in match.match_counts(out).collect()}
    assert counts == {"exact": 1, "near": 4, "none": 3}


def test_raw_titles_and_years_as_text(spark, catalog):
    titles = spark.createDataFrame([("t1", "AMÉLIE?", "2001.0"), ("t2", "Alen", "1980")], "tconst string, primaryTitle string, year string")
    out = match.Enricher.fit(catalog).transform(titles)
    assert {r["tconst"]: (r["genre"], r["match_stage"]) for r in out.collect()} == {
        "t1": ("Drama", "exact"), "t2": ("Sci-fi", "near")
    }


def test_one_search_for_several_tables(spark, catalog):
    titles = spark.createDataFrame(TITLES, "tconst string, normalized_title string, year int")
    enricher = match.Enricher.fit(catalog)
    parts = [titles.where("tconst < 't4'"), titles.where("tconst >= 't4'")]
    matches = enricher.match(*parts)
    together = [r for part in parts for r in rows_of(enricher.transform(part, matches))]
    assert sorted(together, key=repr) == rows_of(enricher.transform(titles))


def test_ties_go_to_the_nearer_year_then_the_smaller_title(spark):
    rows = [("abcx", 2001, 1.0), ("abcy", 2000, 2.0), ("abcz", 2000, 3.0)]
    catalog = spark.createDataFrame(rows, "normalized_title string, release_year int, tomatoMeter double")
    keys = spark.createDataFrame([("abc", 2000)], "normalized_title string, year int")
    assert rows_of(match.match_near(keys, catalog)) == [("abc", 2000, 1, "abcy", 2000)]


def test_hot_title_keeps_every_row(spark, catalog, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 100)
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    titles = spark.range(3_000).select(
        F.col("id").cast("string").alias("tconst"),
        F.when(F.col("id") % 3 == 0, "amelie").otherwise(F.concat(F.lit("z"), "id")).alias("normalized_title"),
        F.lit(2001).alias("year"),
    )
    out = match.Enricher.fit(catalog).transform(titles)
    assert {r["match_stage"]: r["rows"] for r in match.match_counts(out).collect()} == {"exact": 1_000, "none": 2_000}


def test_scores_that_are_nan_are_missing(spark):
    ratings = spark.createDataFrame(
        [("A film", "1999-01-01", None, "NaN", "NaN", "Drama"), ("B film", "1999-01-01", None, "5", "nan", "War")],
        "title string, releaseDateTheaters string, releaseDateStreaming string, tomatoMeter string,"
        " audienceScore string, genre string",
    )
    titles = spark.createDataFrame([("a film", 1999), ("b film", 1999)], "normalized_title string, year int")
    rows = {r["normalized_title"]: r for r in match.Enricher.fit(ratings).transform(titles).collect()}
    assert rows["a film"]["match_stage"] == "near" and rows["a film"]["has_rt_match"] == 0
    assert rows["a film"]["tomatoMeter"] is None
    assert rows["b film"]["match_stage"] == "exact" and rows["b film"]["audienceScore"] is None


def test_one_shuffle_per_side(spark, monkeypatch):
    keys = scale.reread(spark.range(50).selectExpr("concat('film ', id) normalized_title", "1990 + id % 5 as year"))
    catalog = scale.reread(keys.withColumnRenamed("year", "release_year"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = match.match_near(keys, catalog)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one for each side of the join, one for the best pair per key
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("Exchange") == 3

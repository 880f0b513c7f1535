import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from titleprep import scale
from titleprep.functions import text
from titleprep.operators import match
from titleprep.operators.lists import add_lists
from titleprep.plans import views
from titleprep.plans.cleaning import Cleaner
from titleprep.plans.enrichment import enrich_splits
from titleprep.plans.features import FeatureBuilder

N = r"\N"
SCHEMA = (
    "column0 int, tconst string, primaryTitle string, originalTitle string, startYear string, endYear string,"
    " runtimeMinutes string, numVotes double, directors string, writers string, label string"
)
TRAIN = [
    (0, "t1", "Amélie", None, "2001", N, "122", 100.0, "d1", "a,b", "True"),
    (1, "t2", "Heat", "Heat", "1800", N, "0", 50.0, "d1", N, "False"),
    (2, "t3", "Alien", "Alien ", N, "1979", "999", -5.0, N, "a", "True"),
    (3, "t4", "Solo", "solo", "1999", N, N, None, "d2", "b", "False"),
    (3, "t4", "Solo", "solo", "1999", N, N, None, "d2", "b", "False"),
    (4, "t5", "Brat", "Брат", "1997", N, "100", 70.0, "d3", None, "True"),
]


@pytest.fixture
def train(spark):
    return spark.createDataFrame(TRAIN, SCHEMA)


def test_clean(train):
    model = Cleaner().fit(train)
    # sentinels are out of the medians, values out of range are not
    assert model.medians == {"startYear": 1999.0, "runtimeMinutes": 100.0, "numVotes": 50.0}
    out = model.transform(train)
    assert "column0" not in out.columns and "endYear" not in out.columns
    got = {r["tconst"]: r.asDict() for r in out.collect()}
    assert out.count() == 5
    assert (got["t2"]["year"], got["t2"]["runtimeMinutes"], got["t2"]["writers"]) == (1999, 100.0, None)
    assert (got["t3"]["year"], got["t3"]["numVotes"], got["t3"]["directors"]) == (1999, 50.0, None)
    assert (got["t1"]["originalTitle"], got["t1"]["title_is_same"], got["t1"]["label"]) == ("Amélie", 1, 1)
    assert (got["t4"]["title_is_same"], got["t4"]["numVotes"]) == (0, 50.0)
    assert (got["t1"]["normalized_title"], got["t5"]["normalized_title"]) == ("amelie", "brat")


def test_end_year_can_come_first(train):
    got = {r["tconst"]: r["year"] for r in Cleaner(year_order="merge_first").fit(train).transform(train).collect()}
    assert (got["t3"], got["t2"]) == (1979, 1999)
    with pytest.raises(ValueError):
        Cleaner(year_order="other")


def test_training_statistics_do_not_depend_on_other_splits(train, spark):
    other = spark.createDataFrame(TRAIN[:2], SCHEMA).drop("label", "column0")
    model = Cleaner().fit(train)
    out = model.transform(other)
    assert "label" not in out.columns and out.count() == 2
    assert Cleaner(medians="approx").fit(train).medians.keys() == model.medians.keys()


def test_features(train):
    clean = scale.reread(Cleaner().fit(train).transform(train))
    out = FeatureBuilder().fit(clean).transform(clean)
    assert rows_of(out.select("tconst").distinct()) == rows_of(clean.select("tconst"))
    got = {r["tconst"]: r for r in out.collect()}
    assert (got["t1"]["director_success_rate"], got["t1"]["director_movie_count"]) == (0.5, 2.0)
    # fallback: the mean over the keys d1 (1/2), d2 (0), d3 (1)
    assert got["t3"]["director_success_rate"] == pytest.approx(0.5)
    assert got["t3"]["director_movie_count"] == pytest.approx(4 / 3)
    # a: 2 of 2, b: 1 of 2
    assert got["t1"]["writer_success_rate"] == pytest.approx(0.75)
    assert got["t5"]["writer_movie_count"] == pytest.approx(2.0)
    assert out.schema["log_numvotes"].dataType.simpleString() == "float"


def test_enrich_splits(spark):
    rows = [("t1", "heat", 1995), ("t2", "alien", 1979), ("t3", "solo", 1999)]
    train = spark.createDataFrame(rows, "tconst string, normalized_title string, year int")
    val = spark.createDataFrame([("v1", "alienn", 1979)], "tconst string, normalized_title string, year int")
    catalog = spark.createDataFrame(
        [("Heat", "1995-01-01", None, 80, 60, "Crime, Drama"), ("Alien", "1979-01-01", None, 90, 71, None), ("X", "1979-01-01", None, 1, 1, "War")],
        "title string, releaseDateTheaters string, releaseDateStreaming string, tomatoMeter int, audienceScore int, genre string",
    )
    done = enrich_splits({"train": train, "val": val}, catalog)
    assert done["train"].columns == [
        *train.columns, "tomatoMeter", "audienceScore", "has_rt_match", "genre_crime", "genre_drama", "genre_unknown"
    ]
    assert done["train"].columns == done["val"].columns
    got = {r["tconst"]: tuple(r)[3:] for r in done["train"].collect()}
    assert got["t3"] == (85.0, 65.5, 0, 0, 0, 1)
    assert got["t1"] == (80.0, 60.0, 1, 1, 1, 0)
    assert rows_of(done["val"]) == [("v1", "alienn", 1979, 90.0, 71.0, 1, 0, 0, 1)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_near_match_is_an_equality_join_by_shuffle(spark):
    names = spark.createDataFrame([("a", 1)], "t string, y int")
    text_ = plan(match.near_pairs(names, names, ("t", "y"), ("t", "y")))
    assert "SortMergeJoin" in text_
    assert "Cartesian" not in text_ and "NestedLoop" not in text_ and "Broadcast" not in text_


def test_no_python_in_native_paths(spark, train):
    model = Cleaner().fit(train)
    for df in (model.transform(train), train.select(text.normalize_title(F.col("primaryTitle")))):
        assert "EvalPython" not in plan(df)
    exact = train.select(text.normalize_title(F.col("primaryTitle"), exact=True))
    assert "ArrowEvalPython" in plan(exact)


def test_unused_columns_are_not_read(spark, sf_dir):
    text_ = plan(views.titles(spark, sf_dir).select("tconst", "numVotes"))
    assert "lineitem" not in text_, "the writer lists are not needed here"
    assert "o_totalprice" in text_ and "o_custkey" not in text_


def test_titles_are_shuffled_once_for_all_lists(spark):
    titles = spark.range(1_000).select(F.col("id").cast("string").alias("tconst"))
    lists = [titles.groupBy("tconst").agg(F.max("tconst").alias(n)) for n in ("writers", "directors")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text_ = plan(add_lists(titles, *lists))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text_.count("SortMergeJoin") == 2 and text_.count("Exchange hashpartitioning") == 3


def test_few_page_titles_come_to_the_orders(spark, sf_dir):
    from titleprep.plans import views

    rows = views.titles(spark, sf_dir)
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert rows.count() == 1_500

from pyspark.sql import functions as F

from conftest import rows_of
from titleprep.operators import profile

SCHEMA = (
    "tconst string, primaryTitle string, originalTitle string, startYear string, endYear string,"
    " runtimeMinutes string, numVotes double, directors string, writers string, label boolean"
)
N = r"\N"
ROWS = [
    ("tt1", "Amélie", None, "1879", N, "0", 10.0, "nm1", "nm1,nm2", True),
    ("tt2", "Plain", "Plain", "2026", N, "601", -1.0, N, None, False),
    ("tt2", "Other", "X", N, "1999", N, None, None, N, True),
    ("tt3", None, "Y", "1950", N, "90", 0.0, "nm1", "nm3", None),
]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_counts(spark):
    df = frame(spark)
    assert rows_of(profile.row_count(df)) == [(4,)]
    nulls = dict(rows_of(profile.null_counts(df)))
    assert nulls["originalTitle"] == 1 and nulls["numVotes"] == 1 and nulls["label"] == 1 and nulls["tconst"] == 0
    assert dict(rows_of(profile.sentinel_counts(df))) == {
        "startYear": 1, "endYear": 3, "runtimeMinutes": 1, "writers": 1, "directors": 1
    }
    assert rows_of(profile.duplicate_keys(df, "tconst")) == [(1,)]
    assert rows_of(profile.missing(df)) == [(1,)]
    assert rows_of(profile.label_distribution(df)) == [(False, 1), (None, 1), (True, 2)]


def test_ranges(spark):
    df = frame(spark)
    assert rows_of(profile.year_anomalies(df)) == [(1, 1, 1879, 2026)]
    assert rows_of(profile.runtime_anomalies(df)) == [(1, 1, 0.0, 601.0)]
    assert rows_of(profile.vote_anomalies(df)) == [(1, 1, -1.0, 10.0)]


def test_non_ascii(spark):
    df = frame(spark)
    assert rows_of(profile.non_ascii_count(df)) == [(1,)]
    assert rows_of(profile.non_ascii_sample(df)) == [("tt1", "Amélie")]


def test_report_agrees_with_the_single_reports(spark):
    df = frame(spark)
    report = {(s, i): v for s, i, v in rows_of(profile.report(df))}
    assert report["rows", "total_rows"] == 4 and report["year", "max_year"] == 2026
    assert report["sentinels", "endYear"] == 3 and report["titles", "non_ascii"] == 1
    assert report["nulls", "originalTitle"] == 1 and report["runtime", "gt_600"] == 1


def test_summary(spark):
    df = spark.createDataFrame([(1, 0.0, "a"), (1, -0.0, None), (2, None, None)], "k int, x double, s string")
    got = {r["column"]: r for r in profile.column_summary(df).collect()}
    assert (got["x"]["count"], got["x"]["nulls"], got["x"]["unique"]) == (2, 1, 1)
    assert (got["s"]["count"], got["s"]["nulls"], got["s"]["unique"]) == (1, 2, 1)
    assert got["k"]["unique"] == 2 and got["k"]["null_pct"] == 0.0
    ranked = [r["column"] for r in profile.column_summary(df).collect()]
    assert ranked == ["s", "x", "k"]
    assert [r["column"] for r in profile.column_summary(df, order_by="unique").collect()][0] == "k"


def test_summary_per_group_equals_pandas(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 11).alias("a"),
        F.when(F.col("id") % 5 == 0, "x").alias("b"),
    )
    pandas = df.toPandas()
    got = {(r["g"], r["column"]): (r["count"], r["nulls"], r["unique"]) for r in profile.column_summary(df, "g").collect()}
    for g, part in pandas.groupby("g"):
        for c in ("a", "b"):
            assert got[g, c] == (part[c].count(), part[c].isnull().sum(), part[c].nunique())


def test_null_shares(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert rows_of(profile.null_shares(df, ["a", "b"])) == [(2, "a", 1, 50.0), (2, "b", 2, 100.0)]


def test_summary_shuffles_digests_only(spark):
    df = spark.createDataFrame([("x" * 50, 1, -0.0), ("x" * 50, None, 0.0), (None, 2, None)], "a string, b int, c double")
    summary = profile.column_summary(df, order_by=None)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "cast(b" not in plan
    rows = {r["column"]: (r["count"], r["nulls"], r["unique"]) for r in summary.collect()}
    assert rows == {"a": (2, 1, 1), "b": (2, 1, 2), "c": (2, 1, 1)}
    approximate = profile.column_summary(df, order_by="unique", approximate=True)
    assert [r["column"] for r in approximate.collect()] == ["b", "a", "c"]
    assert approximate._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 0
    assert profile.column_summary(df.limit(0), order_by=None).first()["null_pct"] is None


def test_states_of_shards_give_the_report_of_all_rows(spark, tmp_path):
    from titleprep.operators.profile_states import ProfileStates

    columns = "tconst string, primaryTitle string, startYear string, runtimeMinutes string, numVotes double, x double"
    rows = [
        ("t1", "Été", "1870", r"\N", 5.0, 0.0), ("t2", None, r"\N", "700", -1.0, -0.0), ("t3", "a", "2026", "0", None, None),
        ("t4", "a", "1999", "x", float("nan"), 1.5), ("t5", "b", None, "90", 7.0, 1.5),
    ]
    whole = spark.createDataFrame(rows, columns)
    states = ProfileStates(f"{tmp_path}/states")
    shards = {"a/b": rows[:2], "c": rows[2:3], "empty": [], "d=1": rows[3:]}
    states.add("c", whole)
    for name, some in shards.items():
        states.add(name, spark.createDataFrame(some, columns))
    assert rows_of(states.report(spark)) == rows_of(profile.report(whole))
    assert rows_of(states.summary(spark)) == rows_of(profile.column_summary(whole))
    assert rows_of(states.summary(spark, approximate=True)) == rows_of(profile.column_summary(whole))


def test_a_new_shard_reads_only_that_shard(spark, tmp_path):
    from titleprep.operators.profile_states import ProfileStates

    columns = "primaryTitle string, startYear string, runtimeMinutes string, numVotes double"
    states = ProfileStates(f"{tmp_path}/states")
    states.add("1", spark.createDataFrame([("a", "1990", "1", 1.0)], columns))
    states.add("2", spark.createDataFrame([("b", "1991", "1", 1.0)], columns))
    assert {r["item"]: r["value"] for r in states.report(spark).collect()}["total_rows"] == 2
    files = states.report(spark).inputFiles() + states.summary(spark).inputFiles()
    assert all("/states/" in f for f in files)

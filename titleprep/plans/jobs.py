"""The stages from files to files, in the caller's session.

Stages hand on Parquet; CSV is for the ends.  ``read_as`` and ``write_as`` name the
form, ``multiline`` says whether fields of CSV files may hold line breaks.  What a
stage returns is what it wrote, read back; its staging tables are deleted when it ends.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleprep import scale
from titleprep.operators import profile
from titleprep.operators.lists import add_lists, group_list
from titleprep.operators.match import PAYLOAD, match_counts
from titleprep.operators.model import TitleClassifier, TitleModel, accuracy
from titleprep.plans.cleaning import Cleaner
from titleprep.plans.enrichment import Finisher, enrich_splits, match_splits
from titleprep.plans.features import FeatureBuilder
from titleprep.sources.readers import read_columnar_json, read_csv, read_records
from titleprep.sources.writers import in_one_part, write_csv, write_predictions

SPLITS = ("train", "validation", "test")


def _read(
    spark: SparkSession, paths: Mapping[str, str], read_as: str = "parquet", multiline: bool = True
) -> dict[str, DataFrame]:
    if read_as == "csv":
        return {name: read_csv(spark, path, multiline=multiline) for name, path in paths.items()}
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def _write(
    staged: scale.Staging,
    frames: Mapping[str, DataFrame],
    paths: Mapping[str, str],
    write_as: str = "parquet",
    single_file: bool = False,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """The frames as they come back from the files written."""
    for name, path in paths.items():
        if write_as == "csv":
            write_csv(frames[name], path, single_file=single_file)
        else:
            (in_one_part(frames[name]) if single_file else frames[name]).write.mode("overwrite").parquet(path)
    spark = next(iter(frames.values())).sparkSession
    written = _read(spark, paths, write_as, multiline)
    staged.keep(*written.values())
    return written


def merge_files(
    spark: SparkSession,
    base: Mapping[str, str],
    writing: str,
    directing: str,
    out: Mapping[str, str],
    write_as: str = "parquet",
    single_file: bool = False,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """Every split of ``base`` (CSV file, folder or glob) with its writers and directors.

    ``writing`` holds records ``{movie, writer}``, ``directing`` one document of
    columns ``{movie: {..}, director: {..}}``.
    """
    with scale.staging(spark) as staged:
        merged = merge(spark, _read(spark, base, "csv", multiline), writing, directing)
        return _write(staged, merged, out, write_as, single_file, multiline)


def merge(
    spark: SparkSession,
    base: Mapping[str, DataFrame],
    writing: str,
    directing: str,
    documents: bool = True,
) -> dict[str, DataFrame]:
    """``base`` with its lists of people; without ``documents`` the JSON files have one value per line."""
    writers = read_records(spark, writing, "movie string, writer string", multiline=documents)
    directors = read_columnar_json(spark, directing, "movie", "director", multiline=documents)
    lists = [
        scale.store(group_list(pairs, "movie", person, alias).withColumnRenamed("movie", "tconst"))
        for pairs, person, alias in (
            (writers, "writer", "writers"),
            (directors, "director", "directors"),
        )
    ]
    return {name: add_lists(df, *lists) for name, df in base.items()}


def profile_file(
    spark: SparkSession, path: str, read_as: str = "parquet", multiline: bool = True
) -> dict[str, DataFrame]:
    """All data-quality reports of one merged file."""
    df = _read(spark, {"": path}, read_as, multiline)[""]
    return {
        "checks": profile.report(df),
        "duplicates": profile.duplicate_keys(df, "tconst"),
        "labels": profile.label_distribution(df),
        "non_ascii": profile.non_ascii_sample(df),
        "columns": profile.column_summary(df),
    }


def clean_files(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: Mapping[str, str],
    cleaner: Cleaner = Cleaner(),
    read_as: str = "parquet",
    write_as: str = "parquet",
    single_file: bool = False,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    with scale.staging(spark) as staged:
        raw = _read(spark, paths, read_as, multiline)
        model = cleaner.fit(raw["train"])
        cleaned = {name: model.transform(df) for name, df in raw.items()}
        return _write(staged, cleaned, out, write_as, single_file, multiline)


def feature_files(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: Mapping[str, str],
    read_as: str = "parquet",
    write_as: str = "parquet",
    single_file: bool = False,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    with scale.staging(spark) as staged:
        cleaned = _read(spark, paths, read_as, multiline)
        model = FeatureBuilder().fit(cleaned["train"])
        features = {name: model.transform(df) for name, df in cleaned.items()}
        return _write(staged, features, out, write_as, single_file, multiline)


def score_files(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: Mapping[str, str],
    classifier: TitleClassifier = TitleClassifier(),
    read_as: str = "parquet",
    single_file: bool = False,
    multiline: bool = True,
) -> tuple[TitleModel, dict[str, DataFrame]]:
    """Train on the ``train`` file, write one prediction file per path in ``out``.

    Also returns the model and its reports: mean cross-validated score by setting,
    accuracy on the training rows, importances.
    """
    with scale.staging(spark) as staged:
        features = _read(spark, paths, read_as, multiline)
        model = classifier.fit(features["train"])
        for name, path in out.items():
            write_predictions(model.predictions(features[name]), path, classifier.key, single_file)
        reports = {
            "search": model.search_report(spark),
            "accuracy": scale.reread(accuracy(model.transform(features["train"]))),
            "importances": model.importances(spark),
        }
        staged.keep(model.held_out, reports["accuracy"])
        return model, reports


def enrich_files(
    spark: SparkSession,
    paths: Mapping[str, str],
    catalog: str,
    out: Mapping[str, str],
    read_as: str = "parquet",
    write_as: str = "csv",
    single_file: bool = False,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """Enriched splits as files; returns match counts and null shares per split."""
    with scale.staging(spark) as staged:
        ratings = read_csv(spark, catalog, multiline=multiline)
        matched = match_splits(_read(spark, paths, read_as, multiline), ratings)
        matched = {name: scale.reread(df) for name, df in matched.items()}
        finisher = Finisher().fit(matched["train"])
        done = {n: finisher.transform(df.drop("match_stage")) for n, df in matched.items()}
        _write(staged, done, out, write_as, single_file, multiline)
        reports = {
            "matches": scale.reread(_by_split(matched, lambda df: match_counts(df))),
            "nulls": scale.reread(_by_split(matched, lambda df: profile.null_shares(df, PAYLOAD))),
        }
        staged.keep(*reports.values())
        return reports


def chain(
    splits: Mapping[str, DataFrame], catalog: DataFrame, cleaner: Cleaner = Cleaner()
) -> dict[str, DataFrame]:
    """Merged splits to enriched ones: cleaned, with features, scores, match flag and genres.

    Every step is written once to the shared folder.
    """
    model = cleaner.fit(splits["train"])
    cleaned = {name: scale.reread(model.transform(df)) for name, df in splits.items()}
    builder = FeatureBuilder().fit(cleaned["train"])
    features = {name: scale.reread(builder.transform(df)) for name, df in cleaned.items()}
    return enrich_splits(features, catalog)


def chain_files(
    spark: SparkSession,
    base: Mapping[str, str],
    writing: str,
    directing: str,
    catalog: str,
    out: Mapping[str, str],
    write_as: str = "csv",
    single_file: bool = False,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """From the source files to enriched files in one call."""
    with scale.staging(spark) as staged:
        merged = merge(spark, _read(spark, base, "csv", multiline), writing, directing)
        merged = {name: scale.reread(df) for name, df in merged.items()}
        done = chain(merged, read_csv(spark, catalog, multiline=multiline))
        return _write(staged, done, out, write_as, single_file, multiline)


def _by_split(frames: Mapping[str, DataFrame], make) -> DataFrame:
    parts = [make(df).withColumn("split", F.lit(name)) for name, df in frames.items()]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report

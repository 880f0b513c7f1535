"""Typing, range rules, imputation and derived title columns, fitted on the training rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleprep.functions import rules, text
from titleprep.operators.dedup import keep_first
from titleprep.operators.impute import approximate_medians, exact_medians
from titleprep.operators.profile import RUNTIMES, SENTINEL_COLUMNS, YEARS
from titleprep.sources.readers import INDEX_COLUMNS

KEY = "tconst"


def _typed_for_median() -> dict:
    """Raw values without sentinels; the range rules do not apply to the median."""
    return {
        "startYear": rules.to_float(rules.drop_sentinel(F.col("startYear"))),
        "runtimeMinutes": rules.to_float(rules.drop_sentinel(F.col("runtimeMinutes"))),
        "numVotes": rules.to_double(F.col("numVotes")),
    }


def typed(df: DataFrame) -> DataFrame:
    """Index columns dropped, sentinels to null, numbers typed and kept only within their range."""
    df = df.drop(*INDEX_COLUMNS)
    lists = [c for c in SENTINEL_COLUMNS if c in df.columns]
    df = df.withColumns({c: rules.drop_sentinel(F.col(c)) for c in lists})
    return df.withColumns(
        {
            "startYear": rules.within(rules.to_int(F.col("startYear")), *YEARS),
            "runtimeMinutes": rules.above_up_to(rules.to_float(F.col("runtimeMinutes")), *RUNTIMES),
            "numVotes": rules.at_least(rules.to_float(F.col("numVotes")), 0),
        }
    )


@dataclass(frozen=True)
class Cleaner:
    """``year_order``: fill the start year from the median first, or from the end year first.

    ``medians``: ``exact`` lower medians, or ``approx`` from a quantile sketch.
    """

    year_order: str = "impute_first"
    medians: str = "exact"
    exact_titles: bool = False

    def __post_init__(self):
        if self.year_order not in ("impute_first", "merge_first"):
            raise ValueError(f"unknown year_order: {self.year_order}")
        if self.medians not in ("exact", "approx"):
            raise ValueError(f"unknown medians: {self.medians}")

    def fit(self, train: DataFrame) -> CleanerModel:
        columns = _typed_for_median()
        if self.medians == "exact":
            return CleanerModel(self, exact_medians(train, columns))
        return CleanerModel(self, approximate_medians(train, columns))


@dataclass(frozen=True)
class CleanerModel:
    cleaner: Cleaner
    medians: Mapping[str, float | None]

    def impute(self, df: DataFrame) -> DataFrame:
        """Medians in, and the end year merged into ``year``."""
        median = self.medians["startYear"]
        default = F.lit(None if median is None else int(median)).cast("int")
        if "endYear" in df.columns:
            other = rules.within(rules.to_int(F.col("endYear")), *YEARS)
        else:
            other = F.lit(None).cast("int")
        order = (default, other) if self.cleaner.year_order == "impute_first" else (other, default)
        filled = {
            c: F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]).cast("double"))
            for c in ("runtimeMinutes", "numVotes")
        }
        filled["startYear"] = F.coalesce(F.col("startYear"), *order)
        return df.withColumns(filled).drop("endYear").withColumnRenamed("startYear", "year")

    def transform(self, df: DataFrame) -> DataFrame:
        df = self.impute(typed(df))
        df = df.withColumn("originalTitle", F.coalesce("originalTitle", "primaryTitle"))
        if "label" in df.columns:
            df = df.withColumn("label", rules.to_flag(F.col("label")))
        # derived columns follow the shuffle, so that they need not go through it
        return keep_first(df, [KEY]).withColumns(
            {
                "title_is_same": rules.same(F.col("primaryTitle"), F.col("originalTitle")),
                "normalized_title": text.normalize_title(F.col("primaryTitle"), self.cleaner.exact_titles),
            }
        )

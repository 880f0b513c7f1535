"""Scores and genres from a second catalogue for every split, imputed and encoded."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from titleprep import scale
from titleprep.operators.encode import MultiHot, MultiHotModel
from titleprep.operators.impute import MedianImputer, MedianImputerModel, fill_constant
from titleprep.operators.match import SCORES, Enricher

UNKNOWN = "Unknown"


def match_splits(splits: Mapping[str, DataFrame], catalog: DataFrame) -> dict[str, DataFrame]:
    """Every split with its match columns; the catalogue is searched once for all."""
    enricher = Enricher.fit(catalog)
    matches = enricher.match(*splits.values())
    return {name: enricher.transform(df, matches) for name, df in splits.items()}


@dataclass(frozen=True)
class Finisher:
    """Median scores, ``Unknown`` for a missing genre, one column per genre."""

    def fit(self, train: DataFrame) -> FinisherModel:
        imputer = MedianImputer(SCORES, kind="cont").fit(train)
        genres = MultiHot("genre").fit(fill_constant(train, UNKNOWN, "genre"))
        return FinisherModel(imputer, genres)


@dataclass(frozen=True)
class FinisherModel:
    imputer: MedianImputerModel
    genres: MultiHotModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.genres.transform(fill_constant(self.imputer.transform(df), UNKNOWN, "genre"))


def enrich_splits(
    splits: Mapping[str, DataFrame], catalog: DataFrame, train: str = "train"
) -> dict[str, DataFrame]:
    """Matched, imputed and encoded splits; statistics come from ``train`` only."""
    matched = match_splits(splits, catalog)
    matched[train] = scale.reread(matched[train])
    finisher = Finisher().fit(matched[train])
    return {name: finisher.transform(df.drop("match_stage")) for name, df in matched.items()}

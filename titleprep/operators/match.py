"""Matching titles to a second catalogue: exact on (title, year), then within one edit.

Both steps work on the distinct (title, year) pairs of the titles, never on the
rows, so a title that fills a third of the table costs as much as any other.

The step within one edit is an equality join.  Two texts are at most one edit
apart only if they share an element of "the text, and the text with one
character left out".  The join is on the hash of such an element and the year;
the exact distance is checked afterwards.  As texts are distinct, the texts that
share an element are those one letter away from it: a group grows with the
alphabet, not with the data.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleprep import scale
from titleprep.functions import rules, text
from titleprep.operators.dedup import keep_first

SCORES = ("tomatoMeter", "audienceScore")
PAYLOAD = (*SCORES, "genre")
TITLE = "normalized_title"
YEAR = "release_year"


def prepare_catalog(catalog: DataFrame) -> DataFrame:
    """Normalised title, release year, scores and genre; one row per (title, year).

    The row with most scores is kept, ties by the smaller values.  An empty
    title is a title; rows without title or year are left out.
    """
    rows = catalog.select(
        text.normalize_title(F.col("title")).alias(TITLE),
        rules.year_of_first(F.col("releaseDateTheaters"), F.col("releaseDateStreaming")).alias(YEAR),
        *[rules.to_double(F.col(c)).alias(c) for c in SCORES],
        "genre",
    ).dropna("any", subset=[TITLE, YEAR])
    filled = rules.count_present(*[F.col(c) for c in SCORES])
    return keep_first(rows, [TITLE, YEAR], order=[("missing", -filled)])


def match_exact(titles: DataFrame, catalog: scale.Stored) -> DataFrame:
    """Scores and genre of the catalogue row with the same title and year, null without one."""
    keyed = replace(catalog, df=catalog.df.withColumnRenamed(YEAR, "year"))
    return scale.lookup(titles, [keyed], [TITLE, "year"], sparse=True)


def _cut(value: Column, place: Column) -> Column:
    """The text without its character at ``place``; the whole text for 0."""
    after = F.substring(value, place + 1, F.char_length(value))
    return F.when(place == 0, value).otherwise(F.concat(F.substring(value, F.lit(1), place - 1), after))


def with_edit_keys(df: DataFrame, column: str, place: str = "_place") -> DataFrame:
    """One row per hash of the text and of the text with one character left out.

    Leaving out any character of a run gives the same text, so only the last one
    of a run counts.  ``place`` is the character left out, 0 for the whole text.
    """
    value, at = F.col(column), F.col(place)
    letter, following = F.substring(value, at, F.lit(1)), F.substring(value, at + 1, F.lit(1))
    places = df.withColumn(place, F.explode(F.sequence(F.lit(0), F.char_length(value))))
    return places.where((at == 0) | (letter != following)).withColumn("_key", F.xxhash64(_cut(value, at)))


def near_pairs(
    left: DataFrame,
    right: DataFrame,
    left_on: tuple[str, str],
    right_on: tuple[str, str],
    unique: bool = False,
) -> DataFrame:
    """Pairs of distinct (text, number) at most one edit and at most one number apart.

    Texts that differ by one edit share exactly one shortened text, and equal texts
    are taken at the unchanged text only, so a pair comes once; shortened texts are
    compared again after the join on their hashes.  ``unique`` says that both sides
    are distinct already, which spares a shuffle.  Columns: ``text, number,
    near_text, near_number, distance``.
    """
    a = left.select(F.col(left_on[0]).alias("text"), F.col(left_on[1]).cast("int").alias("number")).dropna()
    b = right.select(
        F.col(right_on[0]).alias("near_text"), F.col(right_on[1]).cast("int").alias("near_number")
    ).dropna()
    if not unique:
        a, b = a.distinct(), b.distinct()
    a = with_edit_keys(a, "text")
    b = with_edit_keys(b, "near_text", "_near_place")
    around = F.array(*[F.col("near_number") + d for d in (-1, 0, 1)])
    b = b.withColumn("number", F.explode(around))
    whole = (F.col("_place") == 0) & (F.col("_near_place") == 0)
    same_part = _cut(F.col("text"), F.col("_place")) == _cut(F.col("near_text"), F.col("_near_place"))
    once = F.when(F.col("text") == F.col("near_text"), whole).otherwise(same_part)
    return (
        # size estimates do not see that explode multiplies the rows: rule a broadcast out
        a.join(b.hint("merge"), ["_key", "number"])
        .where(once)
        .select(
            "text",
            "number",
            "near_text",
            "near_number",
            F.levenshtein("text", "near_text", 1).alias("distance"),
        )
        .where("distance >= 0")
    )


def match_near(keys: DataFrame, catalog: DataFrame) -> DataFrame:
    """The closest catalogue key per (title, year) within one edit and one year.

    Both tables are unique by title and year.
    Order: distance, then years apart, then title, then year.
    """
    pairs = near_pairs(keys, catalog, (TITLE, "year"), (TITLE, YEAR), unique=True)
    rank = F.struct(
        "distance",
        F.abs(F.col("number") - F.col("near_number")).alias("apart"),
        "near_text",
        "near_number",
    )
    best = pairs.groupBy("text", "number").agg(F.min(rank).alias("_best"))
    return best.select(
        F.col("text").alias(TITLE),
        F.col("number").alias("year"),
        F.col("_best.distance").alias("distance"),
        F.col("_best.near_text").alias("near_title"),
        F.col("_best.near_number").alias("near_year"),
    )


@dataclass(frozen=True)
class Enricher:
    """Adds scores, genre, match stage and match flag to rows with a title and a year."""

    catalog: scale.Stored

    @classmethod
    def fit(cls, catalog: DataFrame) -> Enricher:
        """``catalog`` as it was read; it is prepared and written once."""
        return cls(scale.store(prepare_catalog(catalog)))

    def _catalog_as(self, title: str, year: str) -> scale.Stored:
        return replace(self.catalog, df=self.catalog.df.withColumnsRenamed({TITLE: title, YEAR: year}))

    def match(self, *tables: DataFrame) -> scale.Stored:
        """One row per (title, year) of ``tables`` that has a match: scores, genre, stage.

        A catalogue row without any score is no exact match; its key goes on to
        the second step, where it finds the same row at distance 0.
        """
        keys = functools.reduce(DataFrame.unionAll, [_keyed(t).select(TITLE, "year") for t in tables])
        keys = keys.dropna().distinct()
        exact = scale.reread(
            scale.lookup(keys, [self._catalog_as(TITLE, "year")], [TITLE, "year"], even=True)
        )
        scored = F.coalesce(*SCORES).isNotNull()
        near = match_near(exact.where(~scored), self.catalog.df)
        # a catalogue key has as many near titles as there are single edits of it
        target = ["near_title", "near_year"]
        found = scale.lookup(near, [self._catalog_as(*target)], target, even=True)
        columns = [TITLE, "year", *PAYLOAD]
        return scale.store(
            exact.where(scored)
            .select(*columns, F.lit("exact").alias("match_stage"))
            .unionByName(found.select(*columns, F.lit("near").alias("match_stage")))
        )

    def transform(self, titles: DataFrame, matches: scale.Stored | None = None) -> DataFrame:
        """All rows and columns of ``titles`` with the match columns added.

        ``matches`` from one call of ``match`` over several tables saves a
        search per table.
        """
        matches = matches or self.match(titles)
        # without the normalised title a second reading costs more than it spares
        joined = scale.lookup(_keyed(titles), [matches], [TITLE, "year"], sparse=TITLE in titles.columns)
        return joined.withColumns(
            {
                "match_stage": F.coalesce("match_stage", F.lit("none")),
                "has_rt_match": rules.present(F.col("tomatoMeter")),
            }
        )


def _keyed(titles: DataFrame) -> DataFrame:
    """``titles`` with both key columns; without a normalised title the primary one serves."""
    if TITLE not in titles.columns:
        titles = titles.withColumn(TITLE, text.normalize_title(F.col("primaryTitle")))
    return titles.withColumn("year", rules.to_int(F.col("year")))


def match_counts(enriched: DataFrame, *group: str) -> DataFrame:
    """Rows per match stage."""
    return enriched.groupBy(*group, "match_stage").agg(F.count(F.lit(1)).alias("rows"))

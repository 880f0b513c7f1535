"""Data-quality reports.  Each one is a DataFrame made in one pass over the columns it needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleprep.functions import rules, text

# Columns that may hold the sentinel, the valid ranges, and the names in the reports.
SENTINEL_COLUMNS = ("startYear", "endYear", "runtimeMinutes", "writers", "directors")
YEARS = (1880, 2025)
RUNTIMES = (0, 600)
YEAR_NAMES = (f"before_{YEARS[0]}", f"after_{YEARS[1]}", "min_year", "max_year")
RUNTIME_NAMES = ("lte_zero", f"gt_{RUNTIMES[1]}", "min_runtime", "max_runtime")
VOTE_NAMES = ("null_votes", "negative_votes", "min_votes", "max_votes")


def _long(wide: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """One row of aggregates as one row per column."""
    return wide.unpivot([], [F.col(f"`{n}`") for n in names], key, value)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
    return _long(df.agg(*counts), df.columns, "column", "nulls")


def sentinel_counts(df: DataFrame, columns: Sequence[str] = SENTINEL_COLUMNS) -> DataFrame:
    counts = [F.count_if(F.col(c).cast("string") == rules.SENTINEL).alias(c) for c in columns]
    return _long(df.agg(*counts), columns, "column", "sentinels")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """How many keys occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_keys"))


def _range_aggregates(value: Column, below: Column, above: Column, names: Sequence[str]):
    return [
        F.sum(F.when(below, 1).otherwise(0)).alias(names[0]),
        F.sum(F.when(above, 1).otherwise(0)).alias(names[1]),
        F.min(value).alias(names[2]),
        F.max(value).alias(names[3]),
    ]


def _year_aggregates(column: str):
    year = rules.to_int(rules.drop_sentinel(F.col(column)))
    return _range_aggregates(year, year < YEARS[0], year > YEARS[1], YEAR_NAMES)


def _runtime_aggregates(column: str):
    minutes = rules.to_float(rules.drop_sentinel(F.col(column)))
    return _range_aggregates(minutes, minutes <= RUNTIMES[0], minutes > RUNTIMES[1], RUNTIME_NAMES)


def _vote_aggregates(column: str):
    votes = rules.to_double(F.col(column))
    found = (F.count_if(F.col(column).isNull()), F.count_if(votes < 0), F.min(votes), F.max(votes))
    return [aggregate.alias(name) for aggregate, name in zip(found, VOTE_NAMES)]


def year_anomalies(df: DataFrame, column: str = "startYear") -> DataFrame:
    return df.agg(*_year_aggregates(column))


def runtime_anomalies(df: DataFrame, column: str = "runtimeMinutes") -> DataFrame:
    return df.agg(*_runtime_aggregates(column))


def vote_anomalies(df: DataFrame, column: str = "numVotes") -> DataFrame:
    return df.agg(*_vote_aggregates(column))


def label_distribution(df: DataFrame, column: str = "label") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(column)


def non_ascii_count(df: DataFrame, column: str = "primaryTitle") -> DataFrame:
    return df.agg(F.count_if(text.is_non_ascii(F.col(column))).alias("non_ascii"))


def non_ascii_sample(
    df: DataFrame, key: str = "tconst", column: str = "primaryTitle", size: int = 5
) -> DataFrame:
    """The first rows, by key, whose text is not plain ASCII."""
    return df.select(key, column).where(text.is_non_ascii(F.col(column))).orderBy(key, column).limit(size)


def missing(df: DataFrame, column: str = "originalTitle") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias(f"null_{column}"))


def checks(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    """The single-number checks of a titles table with these columns: section, item, aggregate."""
    parts: list[tuple[str, str, Column]] = [("rows", "total_rows", F.count(F.lit(1)))]
    parts += [("nulls", c, F.count_if(F.col(f"`{c}`").isNull())) for c in columns]
    parts += [
        ("sentinels", c, F.count_if(F.col(c).cast("string") == rules.SENTINEL)) for c in SENTINEL_COLUMNS if c in columns
    ]
    for section, column, aggregates, names in (
        ("year", "startYear", _year_aggregates, YEAR_NAMES),
        ("runtime", "runtimeMinutes", _runtime_aggregates, RUNTIME_NAMES),
        ("votes", "numVotes", _vote_aggregates, VOTE_NAMES),
    ):
        parts += [(section, n, a) for n, a in zip(names, aggregates(column))]
    parts.append(("titles", "non_ascii", F.count_if(text.is_non_ascii(F.col("primaryTitle")))))
    return parts


def report(df: DataFrame) -> DataFrame:
    """All single-number checks of a titles table from one pass: ``section, item, value``."""
    parts = checks(df.columns)
    names = [f"{section}.{item}" for section, item, _ in parts]
    one = df.agg(*[a.cast("double").alias(n) for n, (_, _, a) in zip(names, parts)])
    return _long(one, names, "check", "value").select(
        F.substring_index("check", ".", 1).alias("section"),
        F.substring_index("check", ".", -1).alias("item"),
        "value",
    )


def digest(name: str, kind: str) -> Column:
    """Sixteen bytes such that equal values, and only they, give equal bytes."""
    col = F.col(f"`{name}`")
    # -0.0 and 0.0 are one value
    col = col + F.lit(0) if kind in ("double", "float") else col
    return F.struct(F.xxhash64(col).alias("a"), F.xxhash64(F.lit("second"), col).alias("b"))


def column_summary(
    df: DataFrame, *group: str, order_by: str | None = "null_pct", approximate: bool = False
) -> DataFrame:
    """Per column (and ``group``): values, nulls, null %, distinct values; ranked by ``order_by``.

    Values and nulls are counted in one pass without a shuffle of the rows.  Distinct
    values are counted by digests of fixed width, once per task and value;
    ``approximate`` takes sketches in that one pass instead.
    """
    names = [c for c in df.columns if c not in group]
    kinds = dict(df.dtypes)
    rows = F.count(F.lit(1)).alias("_rows")
    found = [
        F.struct(
            F.lit(n).alias("column"),
            F.count(F.col(f"`{n}`")).alias("count"),
            *([F.approx_count_distinct(F.col(f"`{n}`")).alias("unique")] if approximate else []),
        )
        for n in names
    ]
    # one array per group, one element per column
    counted = df.groupBy(*group).agg(rows, F.array(*found).alias("_found"))
    counted = counted.select(*group, "_rows", F.inline("_found"))
    if not approximate:
        digests = [
            F.when(
                F.col(f"`{n}`").isNotNull(), F.struct(F.lit(n).alias("column"), digest(n, kinds[n]).alias("_value"))
            )
            for n in names
        ]
        cells = df.select(*group, F.explode(F.array_compact(F.array(*digests))).alias("_cell"))
        unique = cells.select(*group, "_cell.*").distinct().groupBy(*group, "column").agg(F.count(F.lit(1)).alias("unique"))
        same = F.col("c.column") == F.col("u.column")
        for g in group:
            same = same & F.col(f"c.{g}").eqNullSafe(F.col(f"u.{g}"))
        counted = counted.alias("c").join(unique.alias("u"), same, "left").select(
            "c.*", F.coalesce("u.unique", F.lit(0)).alias("unique")
        )
    nulls = F.col("_rows") - F.col("count")
    summary = counted.select(
        *group,
        "column",
        "count",
        nulls.alias("nulls"),
        F.try_divide(nulls * 100.0, F.col("_rows")).alias("null_pct"),
        "unique",
    )
    return summary.orderBy(*group, F.desc(order_by), "column") if order_by else summary


def null_shares(df: DataFrame, columns: Sequence[str], *group: str) -> DataFrame:
    """Rows, nulls and null % of some columns in long form, per ``group``."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    wide = df.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), *counts)
    long = wide.unpivot([*group, "rows"], list(columns), "column", "nulls")
    return long.withColumn("null_pct", F.col("nulls") * 100.0 / F.col("rows"))


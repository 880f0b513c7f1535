"""Medians fitted on the training rows, and filling with them.

A plain exact median keeps every distinct value in one task.  That is fine for
years or minutes and wrong for counts at scale, so ``exact_medians`` first
narrows the range with a bounded quantile sketch until few distinct values are
left, and only then takes the exact value.  Where the sketch does not narrow the
range, it is halved.  Ranks are counted exactly on the way, so the result does not
depend on the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from titleprep import scale

# distinct values one task may hold for the last, exact step
EXACT_DISTINCT = 1_000_000
_ACCURACY = 10_000
_FLOATING = (FloatType(), DoubleType())


@dataclass
class _Search:
    """Open search for the ranks ``first``..``last`` among the values in [low, high]."""

    first: int
    last: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    distinct: int = 0
    ends: tuple[float, float] | None = None

    def condition(self, col: Column) -> Column:
        return col.between(F.lit(self.low), F.lit(self.high))


def _ranks(n: int, kind: str) -> tuple[int, int]:
    if kind == "disc":
        rank = max(1, math.ceil(n / 2))
        return rank, rank
    return (n + 1) // 2, n // 2 + 1


def exact_medians(
    df: DataFrame, columns: Mapping[str, Column], kind: str = "disc", limit: int = EXACT_DISTINCT
) -> dict[str, float | None]:
    """Exact median per column: ``disc`` is the lower middle value, ``cont`` the mean of the middle two."""
    names = list(columns)
    numbers = [F.nullif(columns[n].cast("double"), F.lit(math.nan)).alias(n) for n in names]
    # every pass below reads these few numbers, not the source again
    values = scale.reread(df.select(*numbers))
    counts = values.agg(
        *[F.count(n).alias(f"n_{n}") for n in names],
        *[F.approx_count_distinct(n).alias(f"d_{n}") for n in names],
    ).first()
    searches = {}
    for n in names:
        size = counts[f"n_{n}"]
        if size:
            first, last = _ranks(size, kind)
            searches[n] = _Search(first, last, inside=size, distinct=counts[f"d_{n}"])
    while wide := [n for n, s in searches.items() if s.distinct > limit and s.low < s.high]:
        _narrow(values, {n: searches[n] for n in wide})
    return {n: None for n in names} | _pick(values, searches)


def _narrow(values: DataFrame, searches: Mapping[str, _Search]) -> None:
    """One step: a tighter range from the sketch, then exact counts for it."""
    sketches = []
    for n, s in searches.items():
        margin = 2 / _ACCURACY
        low = max(0.0, (s.first - s.below) / s.inside - margin)
        high = min(1.0, (s.last - s.below) / s.inside + margin)
        inside = F.when(s.condition(F.col(n)), F.col(n))
        sketches.append(F.percentile_approx(inside, [low, high], _ACCURACY).alias(n))
    bounds = values.agg(*sketches).first()
    checks = []
    for n in searches:
        low, high = bounds[n]
        inside = F.col(n).between(low, high)
        checks += [
            F.count_if(F.col(n) < low).alias(f"b_{n}"),
            F.count_if(inside).alias(f"i_{n}"),
            F.approx_count_distinct(F.when(inside, F.col(n))).alias(f"d_{n}"),
        ]
    row = values.agg(*checks).first()
    for n, s in searches.items():
        below, inside = row[f"b_{n}"], row[f"i_{n}"]
        held = below < s.first and s.last <= below + inside
        if held and inside < s.inside:
            s.low, s.high = bounds[n]
            s.below, s.inside, s.distinct = below, inside, row[f"d_{n}"]
        else:
            _halve(values, n, s)


def _halve(values: DataFrame, name: str, s: _Search) -> None:
    """The range cut at the middle between its least and greatest value; exact counts choose the side."""
    col = F.col(name)
    ends = values.where(s.condition(col)).agg(F.min(col).alias("low"), F.max(col).alias("high")).first()
    low, high = ends["low"], ends["high"]
    middle = low / 2 + high / 2
    if not low <= middle < high:
        # neighbouring numbers
        middle = low
    upto, above = col.between(F.lit(low), F.lit(middle)), (col > middle) & (col <= high)
    row = values.agg(
        F.count_if(upto).alias("upto"),
        F.max(F.when(upto, col)).alias("last"),
        F.min(F.when(above, col)).alias("first"),
        F.approx_count_distinct(F.when(upto, col)).alias("d_upto"),
        F.approx_count_distinct(F.when(above, col)).alias("d_above"),
    ).first()
    rank = s.below + row["upto"]
    if s.last <= rank:
        s.low, s.high, s.inside, s.distinct = low, row["last"], row["upto"], row["d_upto"]
    elif s.first > rank:
        s.low, s.high, s.inside, s.distinct = row["first"], high, s.inside - row["upto"], row["d_above"]
        s.below = rank
    else:
        # the two middle values stand on either side
        s.ends = (row["last"], row["first"])
        s.low = s.high = row["last"]
        s.distinct = 0


def _pick(values: DataFrame, searches: Mapping[str, _Search]) -> dict[str, float]:
    picks = []
    found = {n: s.ends or (s.low, s.high) for n, s in searches.items() if s.ends or s.low == s.high}
    for n, s in searches.items():
        if n in found:
            continue
        for end, rank in (("a", s.first), ("b", s.last)):
            share = (rank - s.below - 0.5) / s.inside
            kept = f"case when `{n}` between double('{s.low}') and double('{s.high}') then `{n}` end"
            picks.append(
                F.expr(f"percentile_disc({share!r}d) within group (order by {kept})").alias(f"{end}_{n}")
            )
    if picks:
        row = values.agg(*picks).first()
        found |= {n: (row[f"a_{n}"], row[f"b_{n}"]) for n in searches if n not in found}
    return {n: (a + b) / 2 for n, (a, b) in found.items()}


def approximate_medians(
    df: DataFrame, columns: Mapping[str, Column], accuracy: int = _ACCURACY
) -> dict[str, float | None]:
    names = list(columns)
    row = df.agg(
        *[F.percentile_approx(columns[n].cast("double"), 0.5, accuracy).alias(n) for n in names]
    ).first()
    return {n: row[n] for n in names}


@dataclass(frozen=True)
class MedianImputer:
    """``kind``: ``disc`` lower median, ``cont`` interpolated median, ``approx`` sketch."""

    columns: tuple[str, ...]
    kind: str = "disc"

    def fit(self, train: DataFrame) -> MedianImputerModel:
        columns = {c: F.col(c) for c in self.columns}
        if self.kind == "approx":
            return MedianImputerModel(approximate_medians(train, columns))
        return MedianImputerModel(exact_medians(train, columns, self.kind))


@dataclass(frozen=True)
class MedianImputerModel:
    medians: Mapping[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the medians in place of nulls and NaN."""
        filled = {}
        for c, m in self.medians.items():
            nan = F.lit(math.nan).cast(df.schema[c].dataType)
            known = F.nullif(F.col(c), nan) if df.schema[c].dataType in _FLOATING else F.col(c)
            filled[c] = F.coalesce(known, F.lit(m))
        return df.withColumns(filled)


def fill_constant(df: DataFrame, value: str, *columns: str) -> DataFrame:
    return df.fillna(value, subset=list(columns))

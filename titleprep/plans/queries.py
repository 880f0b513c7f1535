"""Registered queries, each next to the ANSI SQL that must give the same rows.

Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titleprep import scale
from titleprep.functions import rules, text
from titleprep.operators import dedup, encode, impute, lists, match, model, profile, profile_states
from titleprep.plans import jobs
from titleprep.plans.cleaning import Cleaner, typed
from titleprep.plans.enrichment import enrich_splits
from titleprep.plans.features import FeatureBuilder
from titleprep.plans.views import (
    RATINGS_SQL,
    TITLE_COLUMNS,
    TITLES_SQL,
    person,
    ratings,
    table,
    tconst,
    titles,
)
from titleprep.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SPLITS = ("train", "val", "test")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _round(name: str) -> Column:
    return F.round(F.col(name).cast("double"), 6).alias(name)


def _train(rows: DataFrame) -> DataFrame:
    return rows.where("split = 'train'")


def _over_titles(select: str) -> str:
    return f"with {TITLES_SQL} {select}"


def _union_all(parts) -> str:
    return " union all ".join(parts)


# SQL building blocks -------------------------------------------------------

_SENTINEL = "chr(92) || 'N'"


def _sql_int(column: str) -> str:
    return f"try_cast(nullif({column}, {_SENTINEL}) as integer)"


def _sql_float(column: str) -> str:
    return f"try_cast(nullif({column}, {_SENTINEL}) as float)"


def _sql_title(column: str) -> str:
    return (
        "trim(regexp_replace(regexp_replace(lower(strip_accents(" + column + ")),"
        r"'[^\p{L}\p{N}_\s]','','g'),'\s+',' ','g'))"
    )


def _sql_tags(column: str) -> str:
    tag = "replace(replace(lower(trim(x)), ' ', '_'), '&', 'and')"
    return f"list_transform(string_split({column}, ','), lambda x: {tag})"


# the distance function counts bytes: give the one other letter left a single byte
def _sql_ascii(column: str) -> str:
    return f"replace({column}, 'ß', chr(1))"


_YEAR_SQL = f"case when {_sql_int('startYear')} between 1880 and 2025 then {_sql_int('startYear')} end"
_RUNTIME_SQL = (
    f"case when {_sql_float('runtimeMinutes')} > 0 and {_sql_float('runtimeMinutes')} <= 600"
    f" then cast({_sql_float('runtimeMinutes')} as double) end"
)
_VOTES_SQL = "case when numVotes >= 0 then cast(cast(numVotes as float) as double) end"

CLEAN_SQL = f"""
medians as (
  select cast(trunc(quantile_disc({_sql_float('startYear')}, 0.5)) as integer) m_year,
    quantile_disc(cast({_sql_float('runtimeMinutes')} as double), 0.5) m_runtime,
    quantile_disc(numVotes, 0.5) m_votes
  from titles where split = 'train'),
clean as (
  select tconst, primaryTitle, coalesce(originalTitle, primaryTitle) originalTitle,
    coalesce({_YEAR_SQL}, (select m_year from medians)) "year",
    coalesce({_RUNTIME_SQL}, (select m_runtime from medians)) runtimeMinutes,
    coalesce({_VOTES_SQL}, (select m_votes from medians)) numVotes,
    nullif(directors, {_SENTINEL}) directors, nullif(writers, {_SENTINEL}) writers,
    cast(label as integer) label, split,
    case when primaryTitle = coalesce(originalTitle, primaryTitle) then 1 else 0 end title_is_same,
    {_sql_title('primaryTitle')} normalized_title
  from titles)"""

DIRECTORS_SQL = """
director_stats as (
  select directors, cast(sum(label) as double) / count(*) rate, cast(count(*) as double) n
  from (select directors, cast(label as integer) label from {rows} where split = 'train') x
  where directors is not null group by directors),
director_rows as (
  select t.tconst, coalesce(s.rate, (select avg(rate) from director_stats)) director_success_rate,
    coalesce(s.n, (select avg(n) from director_stats)) director_movie_count
  from {rows} t left join director_stats s on s.directors = t.directors)"""

WRITERS_SQL = """
writer_stats as (
  select writer, cast(sum(label) as double) / count(*) rate, cast(count(*) as double) n
  from (select unnest(string_split(writers, ',')) writer, cast(label as integer) label
        from {rows} where split = 'train' and writers is not null) x
  group by writer),
writer_rows as (
  select t.tconst, avg(coalesce(s.rate, (select avg(rate) from writer_stats))) writer_success_rate,
    avg(coalesce(s.n, (select avg(n) from writer_stats))) writer_movie_count
  from (select tconst, unnest(coalesce(string_split(writers, ','), [null])) writer from {rows}) t
  left join writer_stats s on s.writer = t.writer
  group by t.tconst)"""

CATALOG_SQL = f"""
dated as (
  select {_sql_title('title')} normalized_title,
    cast(year(least(try_cast(releaseDateTheaters as date), try_cast(releaseDateStreaming as date)))
      as integer) release_year,
    cast(tomatoMeter as double) tomatoMeter, cast(audienceScore as double) audienceScore, genre
  from ratings),
ranked as (
  select *, row_number() over (
    partition by normalized_title, release_year
    order by (tomatoMeter is not null)::int + (audienceScore is not null)::int desc,
      tomatoMeter nulls first, audienceScore nulls first, genre nulls first) rn
  from dated where normalized_title is not null and release_year is not null),
prepared as (
  select normalized_title, release_year, tomatoMeter, audienceScore, genre from ranked where rn = 1)"""

MATCH_SQL = f"""
exact as (
  select k.normalized_title, k."year", p.tomatoMeter, p.audienceScore, p.genre
  from (select distinct normalized_title, "year" from clean) k
  left join prepared p on p.normalized_title = k.normalized_title and p.release_year = k."year"),
near_pairs as (
  select e.normalized_title, e."year", p.normalized_title near_title, p.release_year near_year,
    cast(levenshtein({_sql_ascii('e.normalized_title')}, {_sql_ascii('p.normalized_title')}) as integer) distance,
    p.tomatoMeter, p.audienceScore, p.genre
  from (select * from exact where tomatoMeter is null and audienceScore is null) e
  join (select *, unnest([release_year - 1, release_year, release_year + 1]) y from prepared) p
    on p.y = e."year" and abs(length(p.normalized_title) - length(e.normalized_title)) <= 1
   and levenshtein({_sql_ascii('e.normalized_title')}, {_sql_ascii('p.normalized_title')}) <= 1),
near as (
  select * from (
    select *, row_number() over (partition by normalized_title, "year"
      order by distance, abs("year" - near_year), near_title, near_year) rn from near_pairs) x
  where rn = 1),
enriched as (
  select c.tconst, c.split,
    case when x.stage = 'exact' then x.tomatoMeter else n.tomatoMeter end tomatoMeter,
    case when x.stage = 'exact' then x.audienceScore else n.audienceScore end audienceScore,
    case when x.stage = 'exact' then x.genre else n.genre end genre,
    case when x.stage = 'exact' then 'exact' when n.rn is not null then 'near'
         else 'none' end match_stage
  from clean c
  left join (select *, case when tomatoMeter is null and audienceScore is null then 'none'
                       else 'exact' end stage from exact) x
    on x.normalized_title = c.normalized_title and x."year" = c."year"
  left join near n on n.normalized_title = c.normalized_title and n."year" = c."year")"""

MATCHED_SQL = f"with {TITLES_SQL}, {RATINGS_SQL}, {CLEAN_SQL}, {CATALOG_SQL}, {MATCH_SQL}"


def _written_titles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The view as a table of its own, for queries that read it several times."""
    rows = titles(spark, sf_dir)
    return scale.reread(rows.select(*columns) if columns else rows)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _written_titles(spark, sf_dir)
    return Cleaner().fit(_train(raw)).transform(raw)


def _splits(rows: DataFrame) -> dict[str, DataFrame]:
    return {name: rows.where(F.col("split") == name) for name in SPLITS}


# profiling -----------------------------------------------------------------


@query(_over_titles("select count(*) total_rows from titles"))
def profile_rowcount(spark, sf_dir):
    return profile.row_count(titles(spark, sf_dir))


@query(
    _over_titles(
        _union_all(
            f"select '{c}' \"column\", count(*) - count({c}) nulls from titles" for c in TITLE_COLUMNS
        )
    )
)
def profile_nulls(spark, sf_dir):
    return profile.null_counts(titles(spark, sf_dir).select(*TITLE_COLUMNS))


@query(
    _over_titles(
        _union_all(
            f"select '{c}' \"column\", count(*) filter (where {c} = {_SENTINEL}) sentinels from titles"
            for c in profile.SENTINEL_COLUMNS
        )
    )
)
def profile_sentinels(spark, sf_dir):
    return profile.sentinel_counts(titles(spark, sf_dir))


@query(
    "select count(*) duplicate_keys from (select l_orderkey, l_linenumber from lineitem"
    " group by l_orderkey, l_linenumber having count(*) > 1) x"
)
def profile_duplicates(spark, sf_dir):
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    _over_titles(
        "select cast(sum(case when yr < 1880 then 1 else 0 end) as bigint) before_1880,"
        " cast(sum(case when yr > 2025 then 1 else 0 end) as bigint) after_2025,"
        f" min(yr) min_year, max(yr) max_year from (select {_sql_int('startYear')} yr from titles) x"
    )
)
def profile_year_range(spark, sf_dir):
    return profile.year_anomalies(titles(spark, sf_dir))


@query(
    _over_titles(
        "select cast(sum(case when rt <= 0 then 1 else 0 end) as bigint) lte_zero,"
        " cast(sum(case when rt > 600 then 1 else 0 end) as bigint) gt_600,"
        " cast(min(rt) as double) min_runtime, cast(max(rt) as double) max_runtime"
        f" from (select {_sql_float('runtimeMinutes')} rt from titles) x"
    )
)
def profile_runtime_range(spark, sf_dir):
    found = profile.runtime_anomalies(titles(spark, sf_dir))
    return found.withColumns({c: F.col(c).cast("double") for c in ("min_runtime", "max_runtime")})


@query(
    _over_titles(
        "select count(*) filter (where numVotes is null) null_votes,"
        " count(*) filter (where numVotes < 0) negative_votes,"
        " min(numVotes) min_votes, max(numVotes) max_votes from titles"
    )
)
def profile_votes(spark, sf_dir):
    return profile.vote_anomalies(titles(spark, sf_dir))


@query(_over_titles('select label, count(*) "count" from titles group by label order by label'))
def profile_labels(spark, sf_dir):
    return profile.label_distribution(titles(spark, sf_dir))


@query(r"select count(*) filter (where regexp_matches(text, '[^\x00-\x7F]')) non_ascii from documents")
def profile_non_ascii(spark, sf_dir):
    return profile.non_ascii_count(table(spark, sf_dir, "documents"), "text")


@query(
    r"select doc_id, text from documents where regexp_matches(text, '[^\x00-\x7F]')"
    " order by doc_id, text limit 5"
)
def profile_non_ascii_sample(spark, sf_dir):
    return profile.non_ascii_sample(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    _over_titles('select count(*) filter (where originalTitle is null) "null_originalTitle" from titles')
)
def profile_title_nulls(spark, sf_dir):
    return profile.missing(titles(spark, sf_dir))


@query(
    _over_titles(
        _union_all(
            f"select split, '{c}' \"column\", count({c}) \"count\", count(*) - count({c}) nulls,"
            f" round((count(*) - count({c})) * 100.0 / count(*), 6) null_pct,"
            f' count(distinct {c}) "unique" from titles group by split'
            for c in TITLE_COLUMNS
        )
    )
)
def column_summary(spark, sf_dir):
    summary = profile.column_summary(titles(spark, sf_dir), "split")
    return summary.withColumn("null_pct", _round("null_pct"))


@query(ORACLES["column_summary"])
def column_summary_by_unique(spark, sf_dir):
    summary = profile.column_summary(titles(spark, sf_dir), "split", order_by="unique")
    return summary.withColumn("null_pct", _round("null_pct"))


def _report_sql() -> str:
    year, runtime = _sql_int("startYear"), _sql_float("runtimeMinutes")
    items = [("rows", "total_rows", "count(*)")]
    items += [("nulls", c, f"count(*) - count({c})") for c in TITLE_COLUMNS]
    items += [
        ("sentinels", c, f"count(*) filter (where {c} = {_SENTINEL})")
        for c in profile.SENTINEL_COLUMNS
    ]
    items += [
        ("year", "before_1880", f"count(*) filter (where {year} < 1880)"),
        ("year", "after_2025", f"count(*) filter (where {year} > 2025)"),
        ("year", "min_year", f"min({year})"),
        ("year", "max_year", f"max({year})"),
        ("runtime", "lte_zero", f"count(*) filter (where {runtime} <= 0)"),
        ("runtime", "gt_600", f"count(*) filter (where {runtime} > 600)"),
        ("runtime", "min_runtime", f"min({runtime})"),
        ("runtime", "max_runtime", f"max({runtime})"),
        ("votes", "null_votes", "count(*) filter (where numVotes is null)"),
        ("votes", "negative_votes", "count(*) filter (where numVotes < 0)"),
        ("votes", "min_votes", "min(numVotes)"),
        ("votes", "max_votes", "max(numVotes)"),
        ("titles", "non_ascii", r"count(*) filter (where regexp_matches(primaryTitle, '[^\x00-\x7F]'))"),
    ]
    return _over_titles(
        _union_all(
            f"select '{s}' section, '{i}' item, cast({e} as double) \"value\" from titles"
            for s, i, e in items
        )
    )


@query(_report_sql())
def profile_report(spark, sf_dir):
    return profile.report(titles(spark, sf_dir).select(*TITLE_COLUMNS))


def _titles_by_shard(spark: SparkSession, sf_dir: str) -> profile_states.ProfileStates:
    """The states of the splits, one shard each; the first is stored twice."""
    rows = scale.reread(titles(spark, sf_dir).select(*TITLE_COLUMNS, "split"))
    states = profile_states.ProfileStates(scale.new_path(spark))
    for split in (SPLITS[0], *SPLITS):
        states.add(split, rows.where(F.col("split") == split).drop("split"))
    return states


@query(ORACLES["profile_report"])
def profile_report_states(spark, sf_dir):
    """The report from states of shards."""
    return _titles_by_shard(spark, sf_dir).report(spark)


@query(
    _over_titles(
        _union_all(
            f"select '{c}' \"column\", count({c}) \"count\", count(*) - count({c}) nulls,"
            f" round((count(*) - count({c})) * 100.0 / count(*), 6) null_pct,"
            f' count(distinct {c}) "unique" from titles'
            for c in TITLE_COLUMNS
        )
    )
)
def column_summary_states(spark, sf_dir):
    """The column summary from states of shards."""
    summary = _titles_by_shard(spark, sf_dir).summary(spark)
    return summary.withColumn("null_pct", _round("null_pct"))


# sources and sinks ---------------------------------------------------------

_TITLES_AS_TEXT = [c for c in (*TITLE_COLUMNS, "split") if c not in ("numVotes", "label")]


@query(_over_titles("select * from titles"))
def csv_roundtrip(spark, sf_dir):
    rows = titles(spark, sf_dir)
    path = scale.new_path(spark)
    writers.write_csv(rows, path)
    back = readers.read_csv(spark, path, readers.text_schema(*rows.columns))
    return back.withColumns(
        {"numVotes": F.col("numVotes").try_cast("double"), "label": F.col("label").try_cast("boolean")}
    )


@query(
    "select cast(c_custkey as varchar) c_custkey, c_name, cast(c_nationkey as varchar) c_nationkey,"
    " c_mktsegment from customer"
)
def csv_shards(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = scale.new_path(spark)
    writers.write_csv(rows.repartition("c_nationkey"), path)
    return readers.read_csv(spark, f"{path}/part-*.csv", multiline=False)


@query("select doc_id, nullif(text, '') text, lang, source from documents")
def csv_ranges(spark, sf_dir):
    """Texts with line breaks in CSV files that several tasks may read."""
    path = scale.new_path(spark)
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    writers.write_csv(rows, path)
    back = readers.read_csv(spark, path, by_ranges=True)
    return back.withColumn("doc_id", F.col("doc_id").cast("long"))


@query(ORACLES["csv_shards"])
def csv_mixed_shards(spark, sf_dir):
    """Shards with columns in another order, one with an index column, read by one glob."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path, third = scale.new_path(spark), F.col("c_custkey") % 3
    writers.write_csv(rows.where(third == 0), f"{path}/first")
    turned = rows.where(third == 1).select("c_mktsegment", "c_nationkey", "c_custkey", "c_name")
    writers.write_csv(turned, f"{path}/second")
    indexed = rows.where(third == 2).select(F.col("c_custkey").alias("column0"), "*")
    writers.write_csv(indexed, f"{path}/third")
    return readers.read_csv(spark, f"{path}/*/part-*.csv", multiline=False).drop("column0")


@query("select event_id, event_type, cast(props->>'k' as integer) k from events")
def record_json_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scale.new_path(spark)
    schema = "event_id bigint, event_type string, props struct<k:int>"
    nested = events.select("event_id", "event_type", F.from_json("props", "k int").alias("props"))
    nested.write.json(path)
    back = readers.read_records(spark, path, schema)
    return back.select("event_id", "event_type", F.col("props.k").alias("k"))


@query(
    "select concat('tt', lpad(cast(o_orderkey as varchar), 7, '0')) movie,"
    " concat('nm', cast(o_custkey as varchar)) director from orders"
)
def columnar_json_rows(spark, sf_dir):
    """Pairs packed into many small documents, then read back as rows.

    A document covers a fixed range of the unique order key, so there are more
    documents, not larger ones, when the table grows.
    """
    pairs = table(spark, sf_dir, "orders").select(
        "o_orderkey", tconst("o_orderkey").alias("movie"), person("o_custkey").alias("director")
    )
    path = scale.new_path(spark)
    _columnar(pairs).write.json(path)
    return readers.read_columnar_json(spark, path, "movie", "director", multiline=False)


@query(ORACLES["columnar_json_rows"])
def columnar_json_document(spark, sf_dir):
    """All pairs in one document in one file, which several tasks may read."""
    pairs = table(spark, sf_dir, "orders").select(
        "o_orderkey", tconst("o_orderkey").alias("movie"), person("o_custkey").alias("director")
    )
    first = pairs.agg(F.min("o_orderkey")).first()[0]
    comma = F.when(F.col("o_orderkey") == first, "").otherwise(",")
    columns = F.array(
        F.struct(F.lit(1).alias("section"), F.lit("m").alias("prefix"), F.col("movie").alias("value")),
        F.struct(F.lit(3).alias("section"), F.lit("d").alias("prefix"), F.col("director").alias("value")),
    )
    member = F.format_string('%s"%s%d": "%s"', comma, "prefix", "o_orderkey", "value")
    lines = pairs.select("o_orderkey", F.inline(columns)).select(
        "section", "o_orderkey", member.alias("line")
    )
    brackets = [(0, 0, '{"movie": {'), (2, 0, '}, "director": {'), (4, 0, "}}")]
    lines = lines.unionByName(scale.literal_table(spark, "section int, o_orderkey bigint, line string", brackets))
    path = scale.new_path(spark)
    writers.in_one_part(lines.orderBy("section", "o_orderkey").select("line")).write.text(path)
    return readers.read_columnar_json(spark, path, "movie", "director", by_ranges=True)


def _columnar(pairs: DataFrame) -> DataFrame:
    """Columns ``movie`` and ``director`` as maps, one document per thousand order keys."""
    packed = (
        pairs.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("document"))
        .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "movie", "director"))).alias("p"))
    )
    # the two maps name their entries differently: only positions line up
    columns = {
        c: F.map_from_arrays(
            F.transform("p.o_orderkey", lambda k: F.concat(F.lit(prefix), k.cast("string"))),
            F.col(f"p.{c}"),
        )
        for c, prefix in (("movie", "m"), ("director", "d"))
    }
    return packed.select(*[e.alias(c) for c, e in columns.items()])


# cleaning ------------------------------------------------------------------


@query(
    _over_titles(
        f"""select tconst, {_YEAR_SQL} "startYear", {_RUNTIME_SQL} "runtimeMinutes",
          {_VOTES_SQL} "numVotes", nullif(endYear, {_SENTINEL}) "endYear",
          nullif(directors, {_SENTINEL}) directors, nullif(writers, {_SENTINEL}) writers,
          coalesce(originalTitle, primaryTitle) "originalTitle", cast(label as integer) label,
          case when primaryTitle = coalesce(originalTitle, primaryTitle) then 1 else 0 end title_is_same
        from titles"""
    )
)
def clean_rules(spark, sf_dir):
    rows = typed(titles(spark, sf_dir)).withColumn(
        "originalTitle", F.coalesce("originalTitle", "primaryTitle")
    )
    return rows.select(
        "tconst",
        "startYear",
        F.col("runtimeMinutes").cast("double").alias("runtimeMinutes"),
        F.col("numVotes").cast("double").alias("numVotes"),
        "endYear",
        "directors",
        "writers",
        "originalTitle",
        rules.to_flag(F.col("label")).alias("label"),
        rules.same(F.col("primaryTitle"), F.col("originalTitle")).alias("title_is_same"),
    )


@query(
    f"with {TITLES_SQL}, {CLEAN_SQL} select tconst, \"year\", runtimeMinutes, numVotes from clean"
)
def impute_disc(spark, sf_dir):
    raw = _written_titles(
        spark, sf_dir, "tconst", "startYear", "endYear", "runtimeMinutes", "numVotes", "split"
    )
    model_ = Cleaner().fit(_train(raw))
    return model_.impute(typed(raw)).select("tconst", "year", "runtimeMinutes", "numVotes")


_FILLED_SQL = (
    "coalesce(cast({c} as double), (select median(cast({c} as double)) from ratings)) {c}"
)


@query(
    f"with {TITLES_SQL}, {RATINGS_SQL} select rating_id, "
    + ", ".join(_FILLED_SQL.format(c=c) for c in match.SCORES)
    + " from ratings"
)
def impute_cont(spark, sf_dir):
    rows = ratings(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in match.SCORES})
    return (
        impute.MedianImputer(match.SCORES, kind="cont")
        .fit(rows)
        .transform(rows)
        .select("rating_id", *match.SCORES)
    )


_KNOWN_SQL = "case when rating_id % 5 = 0 then null else cast({c} as double) end"


@query(
    f"with {TITLES_SQL}, {RATINGS_SQL}, known as (select rating_id, "
    + ", ".join(f"{_KNOWN_SQL.format(c=c)} {c}" for c in match.SCORES)
    + " from ratings) select rating_id, "
    + ", ".join(f"coalesce({c}, (select median({c}) from known)) {c}" for c in match.SCORES)
    + " from known"
)
def impute_nan(spark, sf_dir):
    """Scores as text, some of them the text NaN: missing like any other gap."""
    nan = F.col("rating_id") % 5 == 0
    rows = ratings(spark, sf_dir).withColumns(
        {c: rules.to_double(F.when(nan, "NaN").otherwise(F.col(c).cast("string"))) for c in match.SCORES}
    )
    filled = impute.MedianImputer(match.SCORES, kind="cont").fit(rows).transform(rows)
    return filled.select("rating_id", *match.SCORES)


@query(f"with {TITLES_SQL}, {RATINGS_SQL} select rating_id, coalesce(genre, 'Unknown') genre from ratings")
def impute_const(spark, sf_dir):
    return impute.fill_constant(ratings(spark, sf_dir).select("rating_id", "genre"), "Unknown", "genre")


@query(
    f"with {TITLES_SQL}, {CLEAN_SQL} select tconst, primaryTitle, originalTitle, \"year\","
    " runtimeMinutes, numVotes, directors, writers, label, split, title_is_same, normalized_title"
    " from clean"
)
def clean_titles(spark, sf_dir):
    return _clean(spark, sf_dir)


_END_YEAR_SQL = f"case when {_sql_int('endYear')} between 1880 and 2025 then {_sql_int('endYear')} end"


@query(
    f"with {TITLES_SQL}, "
    + CLEAN_SQL.replace(f"coalesce({_YEAR_SQL}, (", f"coalesce({_YEAR_SQL}, {_END_YEAR_SQL}, (")
    + ' select tconst, "year", runtimeMinutes, numVotes from clean'
)
def clean_merge_first(spark, sf_dir):
    raw = _written_titles(spark, sf_dir)
    cleaned = Cleaner(year_order="merge_first").fit(_train(raw)).transform(raw)
    return cleaned.select("tconst", "year", "runtimeMinutes", "numVotes")


_LINE_ORDER = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,"
    " l_linestatus, l_shipdate"
)


@query(
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,"
    " cast(cast(l_shipdate as date) as varchar) l_shipdate from (select *, row_number() over"
    f" (partition by l_orderkey, l_linenumber order by {_LINE_ORDER}) rn from lineitem) x where rn = 1"
)
def dedup_key(spark, sf_dir):
    best = dedup.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return best.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"),
    )


# lists ---------------------------------------------------------------------

_WRITING_SQL = (
    "select concat('tt', lpad(cast(l_orderkey as varchar), 7, '0')) tconst,"
    " string_agg(concat('nm', cast(l_suppkey as varchar)), ','"
    " order by concat('nm', cast(l_suppkey as varchar))) writers from lineitem group by l_orderkey"
)


def _writing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        tconst("l_orderkey").alias("tconst"), person("l_suppkey").alias("writer")
    )


@query(_WRITING_SQL)
def group_list(spark, sf_dir):
    return lists.group_list(_writing(spark, sf_dir), "tconst", "writer", "writers")


@query(
    f"""select t.tconst, t.o_orderstatus, w.writers, d.directors
    from (select concat('tt', lpad(cast(o_orderkey as varchar), 7, '0')) tconst, o_orderstatus
          from orders) t
    left join ({_WRITING_SQL}) w on w.tconst = t.tconst
    left join (select concat('tt', lpad(cast(o_orderkey as varchar), 7, '0')) tconst,
                 string_agg(case when o_orderkey % 29 <> 0
                   then concat('nm', cast(o_custkey as varchar)) end, ',') directors
               from orders group by o_orderkey) d on d.tconst = t.tconst"""
)
def assemble_lists(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = tconst("o_orderkey").alias("tconst")
    directing = orders.select(
        key, F.when(F.col("o_orderkey") % 29 != 0, person("o_custkey")).alias("director")
    )
    return lists.add_lists(
        orders.select(key, "o_orderstatus"),
        lists.group_list(_writing(spark, sf_dir), "tconst", "writer", "writers"),
        lists.group_list(directing, "tconst", "director", "directors"),
        even=True,
    )


@query(
    ORACLES["assemble_lists"].replace("t.o_orderstatus", "t.o_orderstatus, t.o_orderpriority").replace(
        "tconst, o_orderstatus\n", "tconst, o_orderstatus, o_orderpriority\n"
    )
)
def merge_sources(spark, sf_dir):
    """Shards, records and columnar documents as files, merged to one table."""
    orders = table(spark, sf_dir, "orders")
    key, path = tconst("o_orderkey").alias("tconst"), scale.new_path(spark)
    base = orders.select(key, "o_orderstatus", "o_orderpriority", "o_orderkey")
    even = F.col("o_orderkey") % 2 == 0
    writers.write_csv(base.where(even).drop("o_orderkey"), f"{path}/base/a")
    writers.write_csv(
        base.where(~even).select("o_orderpriority", "tconst", "o_orderstatus"), f"{path}/base/b"
    )
    writing = _writing(spark, sf_dir).withColumnRenamed("tconst", "movie")
    writing.write.json(f"{path}/writing")
    director = F.when(F.col("o_orderkey") % 29 != 0, person("o_custkey")).alias("director")
    _columnar(orders.select("o_orderkey", tconst("o_orderkey").alias("movie"), director)).write.option(
        "ignoreNullFields", False
    ).json(f"{path}/directing")
    rows = readers.read_csv(spark, f"{path}/base/*/part-*.csv", multiline=False)
    return jobs.merge(spark, {"all": rows}, f"{path}/writing", f"{path}/directing", documents=False)["all"]


# text ----------------------------------------------------------------------


@query(
    f"select 'document' kind, doc_id id, cast(0 as bigint) turn, {_sql_title('text')} title from documents"
    f" union all select 'conversation', conv_id, turn, {_sql_title('text')} from conversations"
)
def normalize_title(spark, sf_dir):
    title = text.normalize_title(F.col("text")).alias("title")
    texts = scale.spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    documents = texts.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), title
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("conversation").alias("kind"), F.col("conv_id").alias("id"), "turn", title
    )
    return documents.unionByName(turns)


@query(
    f"with {TITLES_SQL}, {RATINGS_SQL} select rating_id,"
    f" array_to_string({_sql_tags('genre')}, ',') tags from ratings"
)
def normalize_tags(spark, sf_dir):
    return ratings(spark, sf_dir).select("rating_id", text.normalize_tags(F.col("genre")).alias("tags"))


# encoders ------------------------------------------------------------------


@query("select o_orderkey, round(cast(cast(ln(1 + o_totalprice) as float) as double), 4) log_votes from orders")
def log_votes(spark, sf_dir):
    logged = F.round(rules.log_count(F.col("o_totalprice")).cast("double"), 4)
    return table(spark, sf_dir, "orders").select("o_orderkey", logged.alias("log_votes"))


def _directors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _written_titles(spark, sf_dir, "tconst", "directors", "label", "split")
    encoder = encode.TargetEncoder("directors", "director_success_rate", "director_movie_count")
    return encoder.fit(_train(rows)).transform(rows)


@query(
    f"with {TITLES_SQL}, {DIRECTORS_SQL.format(rows='titles')} select tconst,"
    " round(director_success_rate, 6) director_success_rate,"
    " round(director_movie_count, 6) director_movie_count from director_rows"
)
def target_encode_single(spark, sf_dir):
    rows = _directors(spark, sf_dir)
    return rows.select("tconst", _round("director_success_rate"), _round("director_movie_count"))


@query(
    f"with {TITLES_SQL}, {WRITERS_SQL.format(rows='titles')} select tconst,"
    " round(writer_success_rate, 6) writer_success_rate,"
    " round(writer_movie_count, 6) writer_movie_count from writer_rows"
)
def target_encode_multi(spark, sf_dir):
    rows = _written_titles(spark, sf_dir, "tconst", "writers", "label", "split")
    encoder = encode.TargetEncoder("writers", "writer_success_rate", "writer_movie_count", multi=True, unique_rows=True)
    encoded = encoder.fit(_train(rows)).transform(rows)
    return encoded.select("tconst", _round("writer_success_rate"), _round("writer_movie_count"))


@query(
    f"with {TITLES_SQL}, {RATINGS_SQL} select distinct unnest({_sql_tags('genre')}) tag from ratings"
    " where genre is not null"
)
def tag_vocabulary(spark, sf_dir):
    return encode.tag_vocabulary(ratings(spark, sf_dir), "genre")


# The tags of the ratings view.
_TAGS = ("comedy", "drama", "kids_and_family", "mystery_and_thriller", "sci-fi", "unknown")


def _flags_sql(column: str) -> str:
    tags = _sql_tags(f"coalesce({column}, 'Unknown')")
    return ", ".join(f"cast(list_contains({tags}, '{t}') as integer) \"genre_{t}\"" for t in _TAGS)


@query(f"with {TITLES_SQL}, {RATINGS_SQL} select rating_id, {_flags_sql('genre')} from ratings")
def multi_hot(spark, sf_dir):
    rows = impute.fill_constant(ratings(spark, sf_dir).select("rating_id", "genre"), "Unknown", "genre")
    return encode.MultiHot("genre").fit(rows).transform(rows)


@query(
    f"with {TITLES_SQL}, {RATINGS_SQL} select distinct rating_id, unnest({_sql_tags('genre')}) tag"
    " from ratings where genre is not null"
)
def multi_hot_long(spark, sf_dir):
    rows = ratings(spark, sf_dir).select("rating_id", "genre")
    return encode.MultiHot("genre").fit(rows).long(rows, "rating_id")


@query(
    f"""with lists as (
      select doc_id, {_sql_tags("regexp_replace(text, '[^A-Za-z0-9]+', ',', 'g')")} tags from documents),
    rows as (select distinct doc_id, unnest(tags) tag from lists),
    places as (select tag, row_number() over (order by tag) - 1 i from (select distinct tag from rows) t)
    select l.doc_id, (select count(*) from places) size, count(p.i) n,
      md5(coalesce(string_agg(cast(p.i as varchar), ',' order by p.i), '')) places
    from lists l left join rows r on r.doc_id = l.doc_id left join places p on p.tag = r.tag
    group by l.doc_id"""
)
def multi_hot_vectors(spark, sf_dir):
    """Sparse vectors over all words of the documents, in the order of a distributed index."""
    words = F.regexp_replace("text", "[^A-Za-z0-9]+", ",").alias("words")
    # the rows are read twice, at a cost that follows their texts
    texts = scale.spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = scale.reread(texts.select("doc_id", words))
    vectors = encode.MultiHot("words").fit(rows).vectors(rows, "doc_id")
    return vectors.select("doc_id", F.unwrap_udt("tags").alias("tags")).select(
        "doc_id",
        F.col("tags.size").cast("long").alias("size"),
        F.size("tags.indices").cast("long").alias("n"),
        F.md5(F.array_join(F.col("tags.indices").cast("array<string>"), ",")).alias("places"),
    )


@query(
    f"""with {TITLES_SQL}, {CLEAN_SQL}, {DIRECTORS_SQL.format(rows='clean')},
    {WRITERS_SQL.format(rows='clean')}
    select c.tconst, "year", runtimeMinutes, title_is_same, label,
      round(cast(cast(ln(1 + numVotes) as float) as double), 4) log_numvotes,
      round(director_success_rate, 6) director_success_rate,
      round(director_movie_count, 6) director_movie_count,
      round(writer_success_rate, 6) writer_success_rate,
      round(writer_movie_count, 6) writer_movie_count
    from clean c join director_rows d on d.tconst = c.tconst
    join writer_rows w on w.tconst = c.tconst"""
)
def build_features(spark, sf_dir):
    return _features(spark, sf_dir).select(
        "tconst",
        "year",
        "runtimeMinutes",
        "title_is_same",
        "label",
        F.round(F.col("log_numvotes").cast("double"), 4).alias("log_numvotes"),
        _round("director_success_rate"),
        _round("director_movie_count"),
        _round("writer_success_rate"),
        _round("writer_movie_count"),
    )


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scale.reread(_clean(spark, sf_dir).drop("primaryTitle", "originalTitle", "normalized_title"))
    return FeatureBuilder().fit(_train(rows)).transform(rows)


# matching ------------------------------------------------------------------


@query(f"with {TITLES_SQL}, {RATINGS_SQL}, {CATALOG_SQL} select * from prepared")
def catalog_prepare(spark, sf_dir):
    return match.prepare_catalog(ratings(spark, sf_dir))


def _match_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read several times below: computed once
    return scale.reread(_clean(spark, sf_dir).select("tconst", "normalized_title", "year", "split"))


@query(
    MATCHED_SQL
    + """ select c.tconst, p.tomatoMeter, p.audienceScore, p.genre,
      cast(p.tomatoMeter is null and p.audienceScore is null as integer) unmatched
    from clean c left join prepared p
      on p.normalized_title = c.normalized_title and p.release_year = c."year\""""
)
def match_exact(spark, sf_dir):
    catalog = scale.store(match.prepare_catalog(ratings(spark, sf_dir)))
    rows = _clean(spark, sf_dir).select("tconst", "normalized_title", "year")
    found = match.match_exact(rows, catalog)
    return found.select(
        "tconst", *match.PAYLOAD, F.coalesce(*match.SCORES).isNull().cast("int").alias("unmatched")
    )


@query(
    MATCHED_SQL + ' select normalized_title, "year", distance, near_title, near_year from near'
)
def match_fuzzy(spark, sf_dir):
    catalog = scale.store(match.prepare_catalog(ratings(spark, sf_dir)))
    keys = _clean(spark, sf_dir).select("normalized_title", "year").distinct()
    found = match.match_exact(keys, catalog)
    return match.match_near(found.where(F.coalesce(*match.SCORES).isNull()), catalog.df)


@query(
    "select distinct lower(a.c_name) \"text\", a.c_nationkey number, lower(b.c_name) near_text,"
    " b.c_nationkey near_number, cast(levenshtein(lower(a.c_name), lower(b.c_name)) as integer) distance"
    " from customer a join (select *, unnest([c_nationkey - 1, c_nationkey, c_nationkey + 1]) y"
    " from customer) b on b.y = a.c_nationkey where levenshtein(lower(a.c_name), lower(b.c_name)) <= 1"
)
def match_fuzzy_names(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(F.lower("c_name").alias("name"), "c_nationkey")
    on = ("name", "c_nationkey")
    return match.near_pairs(names, names, on, on)


@query(
    MATCHED_SQL
    + " select tconst, tomatoMeter, audienceScore, genre, match_stage,"
    " case when tomatoMeter is null then 0 else 1 end has_rt_match from enriched"
)
def enrich(spark, sf_dir):
    rows = _match_rows(spark, sf_dir)
    enriched = match.Enricher.fit(ratings(spark, sf_dir)).transform(rows)
    return enriched.select("tconst", *match.PAYLOAD, "match_stage", "has_rt_match")


@query(MATCHED_SQL + ' select split, match_stage, count(*) "rows" from enriched group by split, match_stage')
def match_accounting(spark, sf_dir):
    rows = _match_rows(spark, sf_dir)
    return match.match_counts(match.Enricher.fit(ratings(spark, sf_dir)).transform(rows), "split")


@query(
    MATCHED_SQL
    + _union_all(
        f" select split, count(*) \"rows\", '{c}' \"column\", count(*) - count({c}) nulls,"
        f" round((count(*) - count({c})) * 100.0 / count(*), 6) null_pct from enriched group by split"
        for c in match.PAYLOAD
    )
)
def enrich_nulls(spark, sf_dir):
    rows = _match_rows(spark, sf_dir)
    enriched = match.Enricher.fit(ratings(spark, sf_dir)).transform(rows)
    return profile.null_shares(enriched, match.PAYLOAD, "split").withColumn("null_pct", _round("null_pct"))


@query(
    MATCHED_SQL
    + " select tconst, case when tomatoMeter is null then 0 else 1 end has_rt_match,"
    + ", ".join(
        f" round(coalesce({c}, (select median({c}) from enriched where split = 'train')), 6) {c}"
        for c in match.SCORES
    )
    + f", {_flags_sql('genre')} from enriched"
)
def enrich_encoded(spark, sf_dir):
    rows = _match_rows(spark, sf_dir)
    done = enrich_splits(_splits(rows), ratings(spark, sf_dir))
    wanted = ["tconst", "has_rt_match", *match.SCORES, *[f"genre_{t}" for t in _TAGS]]
    parts = [done[name].select(*[f"`{c}`" for c in wanted]) for name in SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    f"""{MATCHED_SQL}, {DIRECTORS_SQL.format(rows='clean')}, {WRITERS_SQL.format(rows='clean')}
    select c.tconst, c."year", c.runtimeMinutes, c.title_is_same, c.label, c.normalized_title,
      round(cast(cast(ln(1 + c.numVotes) as float) as double), 4) log_numvotes,
      round(d.director_success_rate, 6) director_success_rate,
      round(d.director_movie_count, 6) director_movie_count,
      round(w.writer_success_rate, 6) writer_success_rate,
      round(w.writer_movie_count, 6) writer_movie_count,
      case when e.tomatoMeter is null then 0 else 1 end has_rt_match,"""
    + ", ".join(
        f" round(coalesce(e.{c}, (select median({c}) from enriched where split = 'train')), 6) {c}"
        for c in match.SCORES
    )
    + f", {_flags_sql('e.genre')} from clean c join enriched e on e.tconst = c.tconst"
    " join director_rows d on d.tconst = c.tconst join writer_rows w on w.tconst = c.tconst"
)
def full_chain(spark, sf_dir):
    """Cleaning, features, matching and encoding in one go."""
    done = jobs.chain(_splits_for_jobs(_written_titles(spark, sf_dir)), ratings(spark, sf_dir))
    rounded = [F.col(f"`genre_{t}`") for t in _TAGS]
    rounded += [_round(c) for c in ("director_success_rate", "director_movie_count")]
    rounded += [_round(c) for c in ("writer_success_rate", "writer_movie_count", *match.SCORES)]
    rounded.append(F.round(F.col("log_numvotes").cast("double"), 4).alias("log_numvotes"))
    plain = ("tconst", "year", "runtimeMinutes", "title_is_same", "label", "normalized_title", "has_rt_match")
    parts = [done[name].select(*plain, *rounded) for name in jobs.SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _splits_for_jobs(rows: DataFrame) -> dict[str, DataFrame]:
    return dict(zip(jobs.SPLITS, _splits(rows).values()))


# model ---------------------------------------------------------------------

# one whole setting of the search; the search itself fits six of them five times over
_ONE_SETTING = model.TitleClassifier(depths=(4,), rounds=(200,))


# enough rounds for what only ranks features
_FEW_ROUNDS = dataclasses.replace(_ONE_SETTING, rounds=(20,))


@query()
def score_titles(spark, sf_dir):
    features = scale.reread(_features(spark, sf_dir))
    return _ONE_SETTING.fit(_train(features)).predictions(features.where("split <> 'train'"))


@query()
def feature_importance(spark, sf_dir):
    return _FEW_ROUNDS.fit(_train(_features(spark, sf_dir))).importances(spark)


# a label that is an exact rule: trees must find it, and nothing else; gaps are filled with the median,
# a year on the same side of the rule as the one named here
_RULE_FEATURES = ("title_is_same", "year", "runtimeMinutes", "log_numvotes")


def _rule_sql(year: str) -> str:
    return f"primaryTitle = coalesce(originalTitle, primaryTitle) and coalesce({year}, 1998) >= 1997"


def _rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(titles(spark, sf_dir))
    same = rules.same(F.col("primaryTitle"), F.coalesce("originalTitle", "primaryTitle"))
    return scale.reread(
        rows.select(
            "tconst",
            "split",
            same.alias("title_is_same"),
            F.col("startYear").alias("year"),
            "runtimeMinutes",
            rules.log_count(F.col("numVotes")).alias("log_numvotes"),
            ((same == 1) & (F.coalesce("startYear", F.lit(1998)) >= 1997)).alias("label"),
        )
    )


_RULE_PREDICTIONS_SQL = (
    f"select tconst, case when {_rule_sql(_YEAR_SQL)} then 'True' else 'False' end label"
    " from titles where split <> 'train'"
)


@query(_over_titles(_RULE_PREDICTIONS_SQL))
def score_rule(spark, sf_dir):
    """Predictions of held-out rows for a known rule, with gaps in all numbers."""
    rows = _rule_rows(spark, sf_dir)
    fitted = dataclasses.replace(_ONE_SETTING, features=_RULE_FEATURES).fit(_train(rows))
    return fitted.predictions(rows.where("split <> 'train'"))


@query(
    "select * from (values ('title_is_same', true), ('year', true), ('runtimeMinutes', false),"
    " ('log_numvotes', false)) x(feature, matters)"
)
def importance_rule(spark, sf_dir):
    """Only the columns of the rule have weight."""
    rows = _train(_rule_rows(spark, sf_dir))
    weights = dataclasses.replace(_FEW_ROUNDS, features=_RULE_FEATURES).fit(rows).importances(spark)
    return weights.select("feature", (F.round("importance", 6) > 0).alias("matters"))


# all depths and folds; a tenth of the rounds, whose price is the same for a few rows as for many
_SEARCH = model.TitleClassifier(features=_RULE_FEATURES, rounds=(20, 30), parallelism=8)
_SEARCH_SETTINGS_SQL = " union all ".join(
    f"select 'depth {d}, rounds {r}', '1.000000'" for d, r in _SEARCH.settings()
)


@query(
    _over_titles(
        f"select tconst, label from ({_RULE_PREDICTIONS_SQL}) p"
        f" union all {_SEARCH_SETTINGS_SQL}"
        " union all select 'chosen', 'depth 3, rounds 20' union all select 'accuracy', '1.000000'"
        " union all select 'held out', cast(6 * count(*) as varchar) from titles where split = 'train'"
    )
)
def search_rule(spark, sf_dir):
    """The search over a known rule, which every setting finds: held-out predictions of the chosen
    model, its mean score by setting, its accuracy on the training rows, number of held-out scores."""
    rows = _rule_rows(spark, sf_dir)
    fitted = _SEARCH.fit(_train(rows))
    report = fitted.search_report(spark).withColumn("tconst", F.format_string("depth %d, rounds %d", "depth", "rounds"))
    shown = F.format_string("%.6f", "auc").alias("label")
    accuracy = model.accuracy(fitted.transform(_train(rows)))
    parts = [
        fitted.predictions(rows.where("split <> 'train'")),
        report.select("tconst", shown),
        report.where("chosen").select(F.lit("chosen").alias("tconst"), F.col("tconst").alias("label")),
        accuracy.select(F.lit("accuracy").alias("tconst"), F.format_string("%.6f", "accuracy").alias("label")),
        fitted.held_out.agg(F.count(F.lit(1)).cast("string").alias("label")).select(
            F.lit("held out").alias("tconst"), "label"
        ),
    ]
    return functools.reduce(DataFrame.unionAll, parts)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a written folder, numbered over its files in name order."""
    block = ("file", "start")
    text = spark.read.text(f"{path}/part-*").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value").alias("label"),
    )
    lines = scale.reread(text)
    counted = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    # as many rows as blocks of files
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    started = counted.select(*block, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = scale.lookup(lines, [scale.store(started)], block, even=True)
    return placed.select((F.col("before") + F.col("nth") - F.col("first") + 1).alias("line"), "label")


@query(
    _over_titles(
        "select 'many' file, row_number() over (order by tconst) line, label"
        f" from ({_RULE_PREDICTIONS_SQL}) p union all"
        " select 'single', row_number() over (order by tconst), label"
        f" from ({_RULE_PREDICTIONS_SQL}) p"
    )
)
def prediction_files(spark, sf_dir):
    """Predictions as files without header and key, in many parts and as a single file, read back."""
    held_out = _rule_rows(spark, sf_dir).where("split <> 'train'").withColumn("prediction", F.col("label").cast("int"))
    predictions = held_out.select("tconst", writers.prediction_text(F.col("prediction")).alias("label"))
    parts = []
    for name, single in (("many", False), ("single", True)):
        path = scale.new_path(spark)
        writers.write_predictions(predictions, path, single_file=single)
        parts.append(_lines(spark, path).select(F.lit(name).alias("file"), F.col("line").cast("long"), "label"))
    return parts[0].unionAll(parts[1])


_ENCODED_SQL = (
    f"with {TITLES_SQL}, {DIRECTORS_SQL.format(rows='titles')}, scored as ("
    "select round(d.director_success_rate, 6) score, cast(t.label as integer) label"
    " from titles t join director_rows d on d.tconst = t.tconst)"
)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _directors(spark, sf_dir)
    return rows.select(F.round("director_success_rate", 6).alias("score"), "label")


@query(
    _ENCODED_SQL
    + """, tied as (
      select label, avg(r) over (partition by score) r
      from (select *, row_number() over (order by score) r from scored) x)
    select round((sum(case when label = 1 then r end)
        - cast(sum(label) as double) * (sum(label) + 1) / 2)
      / (cast(sum(label) as double) * sum(1 - label)), 6) auc from tied"""
)
def auc(spark, sf_dir):
    return model.area_under_roc(_scored(spark, sf_dir), "score").select(_round("auc"))


@query(
    _ENCODED_SQL
    + " select round(avg(case when (score >= 0.5) = (label = 1) then 1.0 else 0.0 end), 6) accuracy from scored"
)
def accuracy(spark, sf_dir):
    rows = _scored(spark, sf_dir).withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
    return model.accuracy(rows).select(_round("accuracy"))

"""Input tables for the registered queries, derived from the shared test tables.

``titles`` and ``ratings`` have the columns, gaps and odd values of real title
data.  Titles are the whole ``<title>`` of a page; nothing is cut or left out.
The ``*_SQL`` texts are the same views in ANSI SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleprep import scale

TITLE_COLUMNS = (
    "tconst",
    "primaryTitle",
    "originalTitle",
    "startYear",
    "endYear",
    "runtimeMinutes",
    "numVotes",
    "directors",
    "writers",
    "label",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.selectExpr("page_id", "regexp_extract(html, '<title>(.*?)</title>', 1) title")


def tconst(key: str) -> Column:
    return F.expr(f"concat('tt', lpad(cast({key} as string), 7, '0'))")


def person(key: str) -> Column:
    return F.expr(f"concat('nm', cast({key} as string))")


def _writer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    names = F.array_join(F.sort_array(F.collect_set(person("l_suppkey"))), ",")
    return lines.groupBy("o_orderkey").agg(names.alias("writers"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = scale.store(page_titles(spark, sf_dir), n_pages=F.max("page_id") + 1)
    # orders and lines grow with the data: they meet by key, and titles come to them if they are few
    rows = (
        table(spark, sf_dir, "orders")
        .withColumn("page_id", F.col("o_orderkey") % F.lit(pages.values["n_pages"]))
        .join(_writer_lists(spark, sf_dir).hint("merge"), "o_orderkey", "left")
    )
    rows = scale.lookup(rows, [pages], ["page_id"], even=True)
    return rows.select(
        tconst("o_orderkey").alias("tconst"),
        *[
            F.expr(e)
            for e in (
                "title primaryTitle",
                "case when o_orderkey % 5 = 0 then null when o_orderkey % 3 = 0"
                " then concat(title, ' *') else title end originalTitle",
                "case when o_orderkey % 11 = 0 then chr(92) || 'N' when o_orderkey % 97 = 0"
                " then '1800' else cast(year(o_orderdate) as string) end startYear",
                "case when o_orderkey % 11 = 0 then cast(year(o_orderdate) as string)"
                " else chr(92) || 'N' end endYear",
                "case when o_orderkey % 13 = 0 then chr(92) || 'N' when o_orderkey % 17 = 0"
                " then '0' when o_orderkey % 19 = 0 then '999'"
                " else cast(60 + o_orderkey % 120 as string) end runtimeMinutes",
                "case when o_orderkey % 7 = 0 then null when o_orderkey % 23 = 0 then -1d"
                " else round(o_totalprice, 0) end numVotes",
                "case when o_orderkey % 29 <> 0 then concat('nm', cast(o_custkey as string)) end"
                " directors",
                "writers",
                "o_orderstatus = 'F' label",
                "case when o_orderkey % 10 < 8 then 'train' when o_orderkey % 10 = 8 then 'val'"
                " else 'test' end split",
            )
        ],
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_titles(spark, sf_dir).selectExpr(
        "page_id rating_id",
        "case when page_id % 4 = 1 then concat(substr(title, 1, 2), substr(title, 4))"
        " else title end title",
        "case when page_id % 9 = 0 then 'not a date' when page_id % 6 <> 0"
        " then concat(cast(1995 + page_id % 7 as string), '-06-15') end releaseDateTheaters",
        "case when page_id % 8 <> 0"
        " then concat(cast(1996 + page_id % 5 as string), '-01-31') end releaseDateStreaming",
        "case when page_id % 10 <> 0 then 40 + page_id % 60 end tomatoMeter",
        "case when page_id % 7 <> 0 then 30 + page_id % 70 end audienceScore",
        "case when page_id % 12 = 0 then null when page_id % 3 = 0"
        " then 'Drama, Mystery & thriller' when page_id % 3 = 1 then 'Sci-fi,Kids & family'"
        " else 'Comedy' end genre",
    )


TITLES_SQL = """
page_titles as (
  select page_id, regexp_extract(html, '<title>(.*?)</title>', 1) title from pages),
writer_lists as (
  select l_orderkey k, string_agg(v, ',' order by v) writers
  from (select distinct l_orderkey, concat('nm', cast(l_suppkey as varchar)) v from lineitem) x
  group by l_orderkey),
titles as (
  select concat('tt', lpad(cast(o_orderkey as varchar), 7, '0')) tconst,
    p.title "primaryTitle",
    case when o_orderkey % 5 = 0 then null
         when o_orderkey % 3 = 0 then concat(p.title, ' *') else p.title end "originalTitle",
    case when o_orderkey % 11 = 0 then chr(92) || 'N' when o_orderkey % 97 = 0 then '1800'
         else cast(year(o_orderdate) as varchar) end "startYear",
    case when o_orderkey % 11 = 0 then cast(year(o_orderdate) as varchar)
         else chr(92) || 'N' end "endYear",
    case when o_orderkey % 13 = 0 then chr(92) || 'N' when o_orderkey % 17 = 0 then '0'
         when o_orderkey % 19 = 0 then '999'
         else cast(60 + o_orderkey % 120 as varchar) end "runtimeMinutes",
    case when o_orderkey % 7 = 0 then null when o_orderkey % 23 = 0 then -1.0
         else round(o_totalprice, 0) end "numVotes",
    case when o_orderkey % 29 = 0 then null
         else concat('nm', cast(o_custkey as varchar)) end directors,
    w.writers, o_orderstatus = 'F' label,
    case when o_orderkey % 10 < 8 then 'train' when o_orderkey % 10 = 8 then 'val'
         else 'test' end split
  from (select *, o_orderkey % (select max(page_id) + 1 from pages) page_id from orders) o
  left join page_titles p on p.page_id = o.page_id
  left join writer_lists w on w.k = o_orderkey)"""

RATINGS_SQL = """
ratings as (
  select page_id rating_id,
    case when page_id % 4 = 1 then concat(substr(title, 1, 2), substr(title, 4))
         else title end title,
    case when page_id % 9 = 0 then 'not a date' when page_id % 6 = 0 then null
         else concat(cast(1995 + page_id % 7 as varchar), '-06-15') end "releaseDateTheaters",
    case when page_id % 8 = 0 then null
         else concat(cast(1996 + page_id % 5 as varchar), '-01-31') end "releaseDateStreaming",
    case when page_id % 10 = 0 then null else 40 + page_id % 60 end "tomatoMeter",
    case when page_id % 7 = 0 then null else 30 + page_id % 70 end "audienceScore",
    case when page_id % 12 = 0 then null when page_id % 3 = 0 then 'Drama, Mystery & thriller'
         when page_id % 3 = 1 then 'Sci-fi,Kids & family' else 'Comedy' end genre
  from page_titles)"""

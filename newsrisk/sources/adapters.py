"""Adapters: the driver's test tables -> the pipeline's raw inputs.

The pipeline consumes two raw tables:

* ``raw_events``: one row per event with the columns the extract and the
  preview read (``dt`` DATE is the partition column, ``SQLDATE`` the event date
  as a ``yyyyMMdd`` integer).
* ``raw_articles``: one row per article with a ``;``-separated theme field and
  a ``,``-separated tone field.

In production these are date-partitioned Parquet datasets read with
``newsrisk.sources.readers.read_raw``. For tests and benchmarks they are
derived from the driver tables by the expressions below. Each adapter has a
Spark form and the identical DuckDB SQL text used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsrisk.functions.scalars import yyyymmdd


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _n(c, prefix="N"):
    return F.concat(F.lit(prefix), c.cast("string"))


def dense_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> raw_events, one raw event per source row (no gaps per country)."""
    e = table(spark, sf_dir, "events")
    dt = F.col("ts").cast("date")
    return e.select(
        dt.alias("dt"),
        F.col("event_id").alias("GLOBALEVENTID"),
        yyyymmdd(dt).alias("SQLDATE"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
        .otherwise(_n(F.col("user_id") % 25))
        .alias("ActionGeo_CountryCode"),
        _n(F.col("user_id") % 25).alias("Actor1CountryCode"),
        _n(F.col("event_id") % 25).alias("Actor2CountryCode"),
        F.concat((F.col("user_id") % 22).cast("string"), F.lit("0")).alias("EventCode"),
        (F.col("user_id") % 22).cast("string").alias("EventRootCode"),
        ((F.lit(50.0) - F.col("value")) / F.lit(10.0)).alias("AvgTone"),
        (F.col("event_id") % 21 - 10).cast("double").alias("GoldsteinScale"),
        (F.col("event_id") % 50 + 1).alias("NumMentions"),
        (F.col("event_id") % 10 + 1).alias("NumArticles"),
        (F.col("event_id") % 5 + 1).alias("NumSources"),
    )


def sparse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` x ``orders`` x ``customer`` -> raw_events (real day gaps per country)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    dt = F.col("l_shipdate").cast("date")
    k = F.col("l_orderkey")
    return j.select(
        dt.alias("dt"),
        (k * 8 + F.col("l_linenumber")).alias("GLOBALEVENTID"),
        yyyymmdd(dt).alias("SQLDATE"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .otherwise(_n(F.col("c_nationkey")))
        .alias("ActionGeo_CountryCode"),
        _n(F.col("c_nationkey")).alias("Actor1CountryCode"),
        _n(k % 25).alias("Actor2CountryCode"),
        F.concat((F.col("l_partkey") % 22).cast("string"), F.lit("0")).alias("EventCode"),
        (F.col("l_partkey") % 22).cast("string").alias("EventRootCode"),
        ((F.lit(25.0) - F.col("l_quantity")) / F.lit(5.0)).alias("AvgTone"),
        (k % 21 - 10).cast("double").alias("GoldsteinScale"),
        (k % 50 + 1).alias("NumMentions"),
        (k % 10 + 1).alias("NumArticles"),
        (k % 5 + 1).alias("NumSources"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` -> raw_articles: words of the whole text are the themes."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return d.select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("dt"),
        F.col("doc_id").alias("GKGRECORDID"),
        F.replace(F.col("text"), F.lit(" "), F.lit(";")).alias("V2Themes"),
        F.when(F.col("doc_id") % 50 == 0, F.lit("x,1"))
        .otherwise(
            F.concat(
                (F.col("doc_id") % 11 - 5).cast("string"),
                F.lit(".5,"),
                F.col("n_chars").cast("string"),
            )
        )
        .alias("V2Tone"),
    )


RAW_EVENTS = {"dense": dense_events, "sparse": sparse_events}


def dirty_extract(extract: DataFrame) -> DataFrame:
    """An all-text extract with the faults a feed has: impossible dates, words and NaN for numbers, missing keys.

    Which rows are at fault follows from their root code and country, so SQL can say what should come out.
    """
    text = extract.select(*[F.col(c).cast("string").alias(c) for c in extract.columns])
    code, nothing = F.col("EventRootCode"), F.lit(None).cast("string")
    return text.withColumns(
        {
            "SQLDATE": F.when(code == "7", "20241399").otherwise(F.col("SQLDATE")),
            "AvgTone": F.when(code == "3", "NaN").when(code == "5", "n/a").when(code == "9", nothing).otherwise(F.col("AvgTone")),
            "EventCount": F.when(code == "11", "many").otherwise(F.col("EventCount")),
            "CountryCode": F.when(F.col("CountryCode") == "N3", nothing).otherwise(F.col("CountryCode")),
            "EventRootCode": F.when(code == "15", nothing).otherwise(code),
        }
    )


def plain_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the older layout: ``Themes`` and ``Tone`` only."""
    return articles(spark, sf_dir).withColumnsRenamed({"V2Themes": "Themes", "V2Tone": "Tone"})


# ---- DuckDB text of the same adapters (used by the oracle SQL) ---------------

DIRTY_EXTRACT_SQL = """
SELECT CASE WHEN EventRootCode = '7' THEN '20241399' ELSE CAST(SQLDATE AS VARCHAR) END AS SQLDATE,
       CASE WHEN CountryCode = 'N3' THEN NULL ELSE CountryCode END AS CountryCode,
       CASE WHEN EventRootCode = '15' THEN NULL ELSE EventRootCode END AS EventRootCode,
       CASE WHEN EventRootCode = '11' THEN NULL ELSE EventCount END AS EventCount,
       CASE WHEN EventRootCode IN ('3', '5', '9') THEN NULL ELSE AvgTone END AS AvgTone,
       AvgGoldstein, TotalMentions, TotalArticles, TotalSources
FROM sound_extract
"""

DENSE_EVENTS_SQL = """
SELECT CAST(ts AS DATE) AS dt,
       event_id AS GLOBALEVENTID,
       CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS BIGINT) AS SQLDATE,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE CONCAT('N', CAST(user_id % 25 AS VARCHAR)) END
         AS ActionGeo_CountryCode,
       CONCAT('N', CAST(user_id % 25 AS VARCHAR)) AS Actor1CountryCode,
       CONCAT('N', CAST(event_id % 25 AS VARCHAR)) AS Actor2CountryCode,
       CONCAT(CAST(user_id % 22 AS VARCHAR), '0') AS EventCode,
       CAST(user_id % 22 AS VARCHAR) AS EventRootCode,
       (CAST(50 AS DOUBLE) - value) / CAST(10 AS DOUBLE) AS AvgTone,
       CAST(event_id % 21 - 10 AS DOUBLE) AS GoldsteinScale,
       event_id % 50 + 1 AS NumMentions,
       event_id % 10 + 1 AS NumArticles,
       event_id % 5 + 1 AS NumSources
FROM events
"""

SPARSE_EVENTS_SQL = """
SELECT CAST(l_shipdate AS DATE) AS dt,
       l_orderkey * 8 + l_linenumber AS GLOBALEVENTID,
       CAST(strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS BIGINT) AS SQLDATE,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CONCAT('N', CAST(c_nationkey AS VARCHAR)) END
         AS ActionGeo_CountryCode,
       CONCAT('N', CAST(c_nationkey AS VARCHAR)) AS Actor1CountryCode,
       CONCAT('N', CAST(l_orderkey % 25 AS VARCHAR)) AS Actor2CountryCode,
       CONCAT(CAST(l_partkey % 22 AS VARCHAR), '0') AS EventCode,
       CAST(l_partkey % 22 AS VARCHAR) AS EventRootCode,
       (CAST(25 AS DOUBLE) - l_quantity) / CAST(5 AS DOUBLE) AS AvgTone,
       CAST(l_orderkey % 21 - 10 AS DOUBLE) AS GoldsteinScale,
       l_orderkey % 50 + 1 AS NumMentions,
       l_orderkey % 10 + 1 AS NumArticles,
       l_orderkey % 5 + 1 AS NumSources
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
"""

ARTICLES_SQL = """
SELECT DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS dt,
       doc_id AS GKGRECORDID,
       REPLACE(text, ' ', ';') AS V2Themes,
       CASE WHEN doc_id % 50 = 0 THEN 'x,1'
            ELSE CONCAT(CAST(doc_id % 11 - 5 AS VARCHAR), '.5,', CAST(n_chars AS VARCHAR)) END AS V2Tone
FROM documents
"""

RAW_EVENTS_SQL = {"dense": DENSE_EVENTS_SQL, "sparse": SPARSE_EVENTS_SQL}

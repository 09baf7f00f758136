"""Data-quality profile, run log and freshness checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsrisk.functions.scalars import parse_yyyymmdd


def _missing(df: DataFrame, c: str):
    col = F.col(c)
    miss = col.isNull()
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        miss = miss | F.isnan(col)
    return F.sum(F.when(miss, 1).otherwise(0)).cast("bigint")


def dq_null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column (null, or NaN for floating columns), in column order.

    One aggregate pass over the table, then an unpivot of its single row.
    """
    cols = df.columns
    wide = df.agg(*[_missing(df, c).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "missing")
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return long.select(F.element_at(pos, F.col("column")).alias("position"), "column", "missing")


def dq_coverage(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date_col).alias("min_date"),
        F.max(date_col).alias("max_date"),
    )


def dq_top_roots(clean: DataFrame, k: int = 10) -> DataFrame:
    """Top-k (code, label) by total events; null keys are kept as their own group."""
    return (
        clean.groupBy("EventRootCode", "EventRootLabel")
        .agg(F.sum("EventCount").cast("bigint").alias("EventCount"))
        .orderBy(F.col("EventCount").desc_nulls_last(), F.col("EventRootCode").asc_nulls_last(), "EventRootLabel")
        .limit(k)
    )


def run_log(extract: DataFrame, file_name: str, faulty: DataFrame | None = None) -> DataFrame:
    """One run-log row for an extract: file, rows, min/max SQLDATE, and how many lines were ``faulty`` (if given)."""
    log = extract.agg(
        F.lit(file_name).alias("file"),
        F.count(F.lit(1)).alias("rows"),
        F.min("SQLDATE").alias("min_sqldate"),
        F.max("SQLDATE").alias("max_sqldate"),
    )
    return log if faulty is None else log.withColumn("faulty_lines", faulty.select(F.count(F.lit(1))).scalar())


def footer_coverage(spark, path: str, date_col: str = "date") -> DataFrame:
    """``dq_coverage`` of a Parquet table out of its files' footers: no row is read.

    Spark pushes counts, minima and maxima into its V2 Parquet reader; that reader is chosen in a session of
    its own, so that other queries keep theirs.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return dq_coverage(own.read.parquet(path), date_col)


def published_freshness(spark, clean: str, risk: str, forecast: str, extract: DataFrame) -> DataFrame:
    """``freshness_checks`` of published Parquet tables (paths): the latest dates come from footers, one row in all."""
    latest = lambda path, c: footer_coverage(spark, path, c).first()
    c, r, f = latest(clean, "date"), latest(risk, "date"), latest(forecast, "forecast_date")
    date = lambda d: F.lit(d).cast("date")
    e = extract.select(F.max(parse_yyyymmdd("SQLDATE"))).scalar()
    return spark.range(1).select(
        e.alias("extract_max_date"),
        date(c.max_date).alias("clean_max_date"),
        date(r.max_date).alias("risk_max_date"),
        date(f.max_date).alias("forecast_max_date"),
        F.lit(f.rows).cast("bigint").alias("forecast_rows"),
        (date(c.max_date) == e).alias("clean_matches_extract"),
        (date(c.max_date) == date(r.max_date)).alias("risk_matches_clean"),
        (date(f.max_date) == F.date_add(date(r.max_date), 1)).alias("forecast_is_next_day"),
    )


def run_log_without_extract(spark, directory: str) -> DataFrame:
    """The run-log row of a folder that holds no extract: no file, no rows, and a status that says so."""
    nothing = F.lit(None).cast("string")
    return spark.range(1).select(
        nothing.alias("file"),
        F.lit(0).cast("bigint").alias("rows"),
        nothing.alias("min_sqldate"),
        nothing.alias("max_sqldate"),
        F.lit(f"no extract in {directory}").alias("status"),
    )


def freshness_checks(clean: DataFrame, risk: DataFrame, forecast: DataFrame, extract: DataFrame) -> DataFrame:
    """Latest dates of the extract and the three published tables, and the three refresh rules.

    clean max(date) = extract max(SQLDATE); clean max(date) = risk max(date);
    forecast max(forecast_date) = risk max(date) + 1. Scalar subqueries, one output row.
    """
    e = extract.select(F.max(parse_yyyymmdd("SQLDATE"))).scalar()
    c = clean.select(F.max("date")).scalar()
    r = risk.select(F.max("date")).scalar()
    latest = forecast.select(F.struct(F.max("forecast_date").alias("d"), F.count(F.lit(1)).alias("n"))).scalar()
    f, n = latest.getField("d"), latest.getField("n")
    one = clean.sparkSession.range(1)
    return one.select(
        e.alias("extract_max_date"),
        c.alias("clean_max_date"),
        r.alias("risk_max_date"),
        f.alias("forecast_max_date"),
        n.alias("forecast_rows"),
        (c == e).alias("clean_matches_extract"),
        (c == r).alias("risk_matches_clean"),
        (f == F.date_add(r, 1)).alias("forecast_is_next_day"),
    )

"""Dashboard queries over the curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsrisk.sources.readers import DateLike

KPI_COLUMNS = ["risk_raw", "total_events", "conflict_share", "negative_share", "weighted_avg_tone"]


def _range(df: DataFrame, start: DateLike, end: DateLike, col: str = "date") -> DataFrame:
    if start is not None:
        df = df.where(F.col(col) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(str(end)).cast("date"))
    return df


def global_pulse_slice(
    clean: DataFrame, start: DateLike = None, end: DateLike = None, countries=None, categories=None
) -> DataFrame:
    """Clean rows in an inclusive date range, optionally for some countries / categories."""
    df = _range(clean.where(F.col("date").isNotNull()), start, end)
    if countries:
        df = df.where(F.col("CountryCode").isin(*countries))
    if categories:
        df = df.where(F.col("EventRootLabel").isin(*categories))
    return df


def topic_pulse(theme_daily: DataFrame, themes=None, start: DateLike = None, end: DateLike = None) -> DataFrame:
    df = _range(theme_daily, start, end)
    return df.where(F.col("theme").isin(*themes)) if themes else df


def latest_kpis(
    risk: DataFrame, start: DateLike = None, end: DateLike = None, countries=None, metrics=KPI_COLUMNS
) -> DataFrame:
    """Per country: the latest date inside the range and MAX of each metric on it."""
    df = _range(risk, start, end)
    if countries:
        df = df.where(F.col("CountryCode").isin(*countries))
    latest = df.withColumn("_max", F.max("date").over(Window.partitionBy("CountryCode"))).where(
        F.col("date") == F.col("_max")
    )
    return latest.groupBy("CountryCode", F.col("date").alias("latest_date")).agg(
        *[F.max(m).alias(m) for m in metrics]
    )


def latest_run(forecast: DataFrame) -> DataFrame:
    """Keep only the latest run of a forecast table (scalar subquery)."""
    return forecast.where(F.col("run_date") == forecast.select(F.max("run_date")).scalar())


def risk_trend_with_forecast(risk: DataFrame, forecast: DataFrame) -> DataFrame:
    """Daily risk with the forecast point on its as-of day.

    Left join on (CountryCode, date = as_of_date). The forecast side has one
    row per country; AQE turns the join into a broadcast at run time when its
    measured size allows, and keeps a shuffle join otherwise.
    """
    f = latest_run(forecast).select(
        F.col("CountryCode").alias("f_cc"),
        F.col("as_of_date"),
        "forecast_date",
        "pred_risk_next_day",
    )
    j = risk.join(f, (risk.CountryCode == f.f_cc) & (risk.date == f.as_of_date), "left")
    return j.select(
        "date",
        "CountryCode",
        "risk_raw",
        "forecast_date",
        "pred_risk_next_day",
        (F.col("pred_risk_next_day") - F.col("risk_raw")).alias("pred_delta"),
    )


def forecast_outlook(forecast: DataFrame, k: int | None = 10) -> DataFrame:
    """Latest forecast date only: countries ranked by predicted risk, with delta.

    ``k=None`` returns every country (the map view); otherwise the top ``k``.
    """
    latest = forecast.where(F.col("forecast_date") == forecast.select(F.max("forecast_date")).scalar())
    out = latest.select(
        "forecast_date",
        "CountryCode",
        "pred_risk_next_day",
        "risk_as_of",
        (F.col("pred_risk_next_day") - F.col("risk_as_of")).alias("pred_delta"),
    )
    ranked = out.orderBy(F.col("pred_risk_next_day").desc(), "CountryCode")
    return ranked if k is None else ranked.limit(k)
